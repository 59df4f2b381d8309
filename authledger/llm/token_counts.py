"""Token counts by dynamic programming over prefixes.

The vocabulary has no piece in which a space follows another character, so no token
crosses the start of a run of spaces. A text is therefore a chain of segments, each a run
of spaces with the word after it, and

    tokens(first k segments) = tokens(first k - 1 segments) + tokens(segment k)

is exact. ``Counter.prefixes`` stores this table; truncation and budget questions are
then a binary search in it, without encoding the text again. Segment counts are kept in a
bounded memo. Where a vocabulary does have such pieces, the whole text is one segment.

Edge cases: a null or empty text has no tokens; repeated rows are each counted; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from itertools import accumulate

import sentencepiece
from pyspark.sql import DataFrame

from authledger.llm.common import map_texts, sent

LIMIT = 4096
MEMO = 400_000
SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
SPACE = "▁"
_SEGMENT = re.compile(r" +[^ ]*")


class Counter:
    def __init__(self, model_file: str):
        self.model_file = model_file
        self._model = None
        self.memo: dict[str, int] = {}

    def __getstate__(self) -> dict:
        return {"model_file": self.model_file, "_model": None, "memo": {}}

    @property
    def model(self) -> sentencepiece.SentencePieceProcessor:
        if self._model is None:
            self._model = sentencepiece.SentencePieceProcessor(model_file=self.model_file)
            pieces = map(self._model.id_to_piece, range(self._model.get_piece_size()))
            self.splits = not any(SPACE in piece.lstrip(SPACE) for piece in pieces)
        return self._model

    def segments(self, text: str) -> list[str]:
        """The pieces of the text, the space that the library puts before it included."""
        if not text:
            return []
        self.model  # noqa: B018
        whole = " " + text.replace(SPACE, " ")
        return _SEGMENT.findall(whole) if self.splits else [whole]

    def costs(self, segments: list[str]) -> list[int]:
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        new = list({s for s in segments if s not in memo})
        if new:
            # The library adds the first space of each segment again.
            for segment, ids in zip(new, self.model.encode([s[1:] for s in new], num_threads=1), strict=True):
                memo[segment] = len(ids) if segment != " " else self._lone_space()
        return [memo[s] for s in segments]

    def _lone_space(self) -> int:
        """Tokens of one space at the end of a text."""
        if not hasattr(self, "_lone"):
            self._lone = len(self.model.encode("a ")) - len(self.model.encode("a"))
        return self._lone

    def count(self, text: str) -> int:
        return sum(self.costs(self.segments(text)))

    def prefixes(self, text: str) -> tuple[list[int], list[int]]:
        """(characters, tokens) of every prefix that ends before a space, or at the end."""
        segments = self.segments(text)
        ends = [end - 1 for end in accumulate(map(len, segments))]
        return [0, *ends], [0, *accumulate(self.costs(segments))]

    def longest_prefix(self, text: str, budget: int) -> str:
        """The longest of these prefixes with at most ``budget`` tokens."""
        ends, counts = self.prefixes(text)
        return text[: ends[bisect_right(counts, budget) - 1]] if budget >= 0 else ""


def token_counts(docs: DataFrame, model_file: str, limit: int = LIMIT) -> DataFrame:
    """One row per document: its bytes and tokens, and whether it has over ``limit``."""
    shared = sent(docs.sparkSession, Counter(model_file))

    def each(ids: list[int | None], batch: list[bytes]) -> dict[str, list]:
        counts = [shared().count(text.decode(errors="replace")) for text in batch]
        return {
            "doc_id": ids,
            "n_bytes": [len(text) for text in batch],
            "n_tokens": counts,
            "over_limit": [n > limit for n in counts],
        }

    return map_texts(docs, each, SCHEMA)
