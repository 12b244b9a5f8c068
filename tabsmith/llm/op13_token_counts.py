"""Token counts of whole texts by a byte-pair model with byte fallback.

The count of a text is its number of symbols at the start less the merges made:
a heap holds the adjacent pairs that are pieces of the model, the one of lowest
rank (then the leftmost) is merged next, and symbols hang in a linked list.  No
identifier is ever made.  A character that is no piece and stays unmerged counts
its UTF-8 bytes.

No merge reaches across a space that follows another character, nor across a
line feed (both are read off the model's pieces when it is loaded; where a model
has such pieces texts are not cut).  So texts are cut there and a worker counts
each distinct chunk once, in a memory of bounded size.  A text is counted as a
whole, however long; nothing is shuffled.

Defined cases: null and empty texts have no tokens and 0 bytes; control strings
inside texts are plain text; rows that repeat count each; a null id is kept; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunk_memo import ChunkMemo, piece_starts, sums, text_runs
from .common import release

#: Chunks remembered by one Python worker.
MAX_CHUNKS = 600_000
LIMIT = 4096
MARK = "▁"                # a space, in pieces


class PieceRanks:
    """Ranks of the pieces of a sentence model (lower merges first)."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        if sum(model.is_byte(i) for i in range(n)) != 256:
            raise ValueError("a model with byte fallback is needed")
        self.rank = {model.id_to_piece(i): -model.get_score(i) for i in range(n)
                     if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
        #: No piece crosses a cut.
        self.cuts = not any(MARK in p.lstrip(MARK) or ("\n" in p and len(p) > 1) for p in self.rank)

    def count(self, word: str) -> int:
        """Tokens of a chunk whose spaces are marked."""
        rank, n = self.rank, len(word)
        size, before = [1] * n, list(range(-1, n - 1))     # 0: merged into its left
        heap = [(r, i, 2) for i in range(n - 1) if (r := rank.get(word[i:i + 2])) is not None]
        heapify(heap)
        merges = 0
        while heap:
            _, i, length = heappop(heap)
            j = i + size[i]
            if not size[i] or j >= n or size[i] + size[j] != length:
                continue                                   # one of the two has changed
            size[i], size[j] = length, 0
            merges += 1
            after = i + length
            if after < n:
                before[after] = i
                total = length + size[after]
                if (r := rank.get(word[i:i + total])) is not None:
                    heappush(heap, (r, i, total))
            if (left := before[i]) >= 0:
                total = size[left] + length
                if (r := rank.get(word[left:left + total])) is not None:
                    heappush(heap, (r, left, total))
        spare = sum(len(word[i].encode()) - 1 for i in range(n) if size[i] == 1 and word[i] not in rank)
        return n - merges + spare


class TokenCounter:
    """Counts texts; one lives in each Python worker."""

    def __init__(self, path: str, most: int = MAX_CHUNKS):
        self.ranks = PieceRanks(path)
        self.memo = ChunkMemo(self._learn, self._forget, most)
        self._forget()

    def _forget(self) -> None:
        self.counts = np.empty(0, np.int64)

    def _learn(self, chunks: list[bytes]) -> None:
        new = [self.ranks.count(c.decode().replace(" ", MARK)) for c in chunks]
        self.counts = np.concatenate([self.counts, np.array(new, np.int64)])

    def count(self, column: pa.Array) -> np.ndarray:
        out = [np.empty(0, np.int64)]
        for _, data, offsets in text_runs(column):
            if self.ranks.cuts:
                starts = piece_starts(data, offsets)
            else:
                starts = np.unique(offsets[:-1][np.diff(offsets) > 0])
            numbers = self.memo.find(data, starts)
            out.append(sums(self.counts[numbers], np.searchsorted(starts, offsets)))
        return np.concatenate(out)


_COUNTERS: dict[str, TokenCounter] = {}


def counter(path: str) -> TokenCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = TokenCounter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, model: str, limit: int = LIMIT, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every document."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own.count(batch.column(2)))],
                                             ["id", "n_bytes", "n_tokens"])
            release()

    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"),
                       F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), text.alias("text"))
    return (rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
            .select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
