"""Hierarchical packing of token ids into context windows of several lengths.

Documents are routed to tiers of context length (for a window of 2048: 256, 512, 1024 and 2048). Whole windows are cut off long
documents; each tier packs what is left in sequences of its length, longest tier first, and the gaps of long windows are
filled from shorter tiers, cutting the last piece to fit. What no window can fill at the end of a task is cut at powers of two.
Every task packs its own documents: nothing is shuffled. Finished sequences go to the least loaded of the open step groups, so that groups hold
nearly equal numbers of tokens.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_right, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchardflow.llm._common import map_batches, slices
from orchardflow.llm.token_counts import chunk_ids, encode_all, looked_up, separable

#: Left-over tails (shorter than a window) that a task holds before it packs them; bounds memory, whatever the input.
HELD = 2048
_caches: dict[str, dict] = {}


class Packer:
    """Packs documents' ids, as bytes of four a token, and collects a row for each piece placed."""

    def __init__(self, window: int, first_id: int, step_groups: int = 8, step_windows: int = 16) -> None:
        if window & (window - 1):
            raise ValueError("the window must be a power of two")
        self.window, self.next_id, self.step_tokens = window, first_id, window * step_windows
        self.tiers = [x for x in (window >> 3, window >> 2, window >> 1, window) if x]
        self.rows: list[tuple] = []
        #: tails by tier, sorted by length: (tokens, n, document, start, ids)
        self.tails: list[list[tuple]] = [[] for _ in self.tiers]
        self.tokens = [0] * len(self.tiers)
        self.count = 0
        self.next_step = first_id
        self.groups: list[list[int]] = []
        for _ in range(step_groups):
            self._open_group()

    def _open_group(self) -> None:
        self.groups.append([0, self.next_step])
        self.next_step += 1

    def add(self, document: int | None, ids: bytes) -> None:
        tokens = len(ids) >> 2
        start = 0
        while tokens - start >= self.window:
            self._place([(self.window, 0, (document, tokens), start, ids[4 * start : 4 * (start + self.window)])])
            start += self.window
        if tokens > start:
            self._hold((tokens - start, self.count, (document, tokens), start, ids[4 * start :]))
            self.count += 1
        if sum(map(len, self.tails)) >= HELD:
            self.pack()

    def _hold(self, tail: tuple) -> None:
        tier = next(i for i, x in enumerate(self.tiers) if tail[0] <= x)
        insort(self.tails[tier], tail, key=lambda x: (x[0], x[1]))
        self.tokens[tier] += tail[0]

    def _take(self, tier: int, at: int = -1) -> tuple:
        tail = self.tails[tier].pop(at)
        self.tokens[tier] -= tail[0]
        return tail

    def _fitting(self, gap: int, top: int) -> tuple | None:
        """The longest tail of the tiers up to ``top`` that fits the gap; else the longest one there, cut to fit."""
        for tier in range(top, -1, -1):
            at = bisect_right(self.tails[tier], gap, key=lambda x: x[0])
            if at:
                return self._take(tier, at - 1)
        for tier in range(top + 1):
            if self.tails[tier]:
                n, count, document, start, ids = self._take(tier)
                self._hold((n - gap, count, document, start + gap, ids[4 * gap :]))
                return gap, count, document, start, ids[: 4 * gap]
        return None

    def pack(self, last: bool = False) -> None:
        """Pack held tails, longest tier first; what fills no sequence stays held unless this is the last call."""
        for top in range(len(self.tiers) - 1, -1, -1):
            length = self.tiers[top]
            while self.tails[top]:
                if not last and sum(self.tokens[: top + 1]) < length:
                    break
                pieces, gap = [self._take(top)], length
                gap -= pieces[0][0]
                while gap and (more := self._fitting(gap, top)) is not None:
                    pieces.append(more)
                    gap -= more[0]
                if not gap:
                    self._place(pieces)
                    continue
                while pieces:  # all tails are used up: cut at powers of two
                    size = 1 << (sum(x[0] for x in pieces).bit_length() - 1)
                    now, room = [], size
                    while room:
                        n, count, document, start, ids = pieces.pop(0)
                        take = min(n, room)
                        now.append((take, count, document, start, ids[: 4 * take]))
                        if take < n:
                            pieces.insert(0, (n - take, count, document, start + take, ids[4 * take :]))
                        room -= take
                    self._place(now)

    def _place(self, pieces: list[tuple]) -> None:
        length = sum(x[0] for x in pieces)
        group = min(self.groups)
        group[0] += length
        offset = 0
        for n, _, (document, tokens), start, ids in pieces:
            self.rows.append((document, start, n, zlib.crc32(ids), tokens, self.next_id, offset, length, group[1], ids))
            offset += n
        self.next_id += 1
        if group[0] >= self.step_tokens:
            self.groups.remove(group)
            self._open_group()


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", window: int = 2048, end_id: int = 1, keep_ids: bool = True) -> DataFrame:
    """A row for each piece: id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_length, step_group and, if ``keep_ids``, ids.

    A document is its text's ids and ``end_id``; a null or empty text is ``end_id`` alone. Every id lies in exactly one piece.
    Sequences hold at most ``window`` ids; all are full or a power of two long. Repeated rows are packed each. Null ids stay.
    An empty table gives no rows. Extra columns are ignored. ``sequence_id`` and ``step_group`` are unique over all tasks.
    """
    split = separable(vocabulary)
    end = array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _caches.setdefault(vocabulary, {})
        packer = Packer(window, TaskContext.get().partitionId() << 40)
        for batch in slices(batches):
            texts = [x or "" for x in batch.column(1).to_pylist()]
            if split:
                found = map(b"".join, looked_up(texts, cache, lambda parts: chunk_ids(vocabulary, parts)))
            else:
                found = (array("I", x).tobytes() for x in encode_all(vocabulary, texts))
            for document, ids in zip(batch.column(0).to_pylist(), found, strict=True):
                packer.add(document, ids + end)
            yield out(packer)
        packer.pack(last=True)
        yield out(packer)

    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_length", "step_group"]

    def out(packer: Packer) -> pa.RecordBatch:
        rows, packer.rows = packer.rows, []
        columns = list(zip(*rows, strict=True)) or [()] * 10
        arrays = [pa.array(x, pa.int64()) for x in columns[:9]]
        if keep_ids:
            arrays.append(pa.array([memoryview(x).cast("I").tolist() for x in columns[9]], pa.list_(pa.int64())))
        return pa.RecordBatch.from_arrays(arrays, [*names, "ids"][: len(arrays)])

    schema = ", ".join(f"{x} long" for x in names) + ", ids array<long>" * keep_ids
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, run, schema).withColumnRenamed("id", id_col)
