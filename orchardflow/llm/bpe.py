"""Byte-level BPE with a hierarchical-bitmap rank queue.

The pre-tokens of a batch lie one after another in one doubly linked list of parts. Every pair of neighbours that can merge is
queued in the bucket of its merge rank; a three-level bitmap marks the ranks whose buckets are in use, so that finding
the next rank is a find-first-set at each level. A bucket holds list positions and is merged at once, from the left. Small buckets
of the next ranks are taken together; of each pre-token only the entries of its least rank among them merge, the others go back to
their buckets. Entries whose pair has changed since they were queued are stale and skipped. The cost grows in proportion to a
pre-token's length.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchardflow.llm._common import map_batches, slices
from orchardflow.llm.token_counts import LONGEST, looked_up

#: Splits a text before merges: contractions, letters, digits, other marks, white space.
PATTERN = public_tokenizers.PATTERN
#: White space other than spaces and line feeds: in ASCII, and beyond it.
ASCII_SPACE = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f"
OTHER_SPACE = ASCII_SPACE + "\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
SURE = regex.compile(r"(?<=\S) (?=\S)")
#: Chunks of letters, with one mark at most after them, need no splitting by the pattern.
SIMPLE = re.compile("([A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-&(-/:-@[-`{-~]?)")
#: Most pieces, and most pre-tokens, whose ids a worker keeps. Only speed depends on it.
CACHE = 700_000
#: Texts encoded together: the rank queue handles the new pre-tokens of so many at once.
TOGETHER = 2048
#: Entries from which a bucket is merged by itself; smaller buckets are taken together until they have so many.
ALONE = 2048
_coders: dict[tuple, ByteBPE] = {}


class RankQueue:
    """Positions in buckets by rank, with a bitmap of three levels of 64-bit words over the ranks in use."""

    def __init__(self, ranks: int) -> None:
        self.buckets: dict[int, list[int]] = {}
        self.low = [0] * ((ranks >> 6) + 1)
        self.mid = [0] * ((ranks >> 12) + 1)
        self.top = 0

    def mark(self, rank: int) -> None:
        word = rank >> 6
        if not self.low[word]:
            self.mid[word >> 6] |= 1 << (word & 63)
            self.top |= 1 << (word >> 6)
        self.low[word] |= 1 << (rank & 63)

    def push(self, ranks: np.ndarray, places: np.ndarray) -> None:
        """Queue places under their ranks; a negative rank is none."""
        buckets = self.buckets
        for rank, at in zip(ranks.tolist(), places.tolist(), strict=True):
            if rank >= 0:
                held = buckets.get(rank)
                if held is None:
                    buckets[rank] = [at]
                    self.mark(rank)
                else:
                    held.append(at)

    def pop(self) -> tuple[int, list[int]] | None:
        """The least rank in use and its places; None when empty."""
        if not self.top:
            return None
        high = (self.top & -self.top).bit_length() - 1
        word = high << 6 | (self.mid[high] & -self.mid[high]).bit_length() - 1
        rank = word << 6 | (self.low[word] & -self.low[word]).bit_length() - 1
        self.low[word] &= self.low[word] - 1
        if not self.low[word]:
            self.mid[high] &= self.mid[high] - 1
            if not self.mid[high]:
                self.top &= self.top - 1
        return rank, self.buckets.pop(rank)

    def pop_some(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Ranks and places of the next buckets: the least rank in use, and those after it until ``most`` entries are taken."""
        ranks, places = [], []
        while len(places) < most and (found := self.pop()) is not None:
            ranks.append((found[0], len(found[1])))
            places += found[1]
        rank, n = np.array(ranks, np.int64).reshape(-1, 2).T
        return np.repeat(rank, n), np.array(places, np.int64)


class ByteBPE:
    """Encoder and decoder for a rank file: a line for each token, its bytes in base64 and its rank."""

    def __init__(self, path: str, pattern: str = PATTERN) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        self.size = max(self.ranks.values()) + 1
        self.bytes_of: list[bytes] = [b""] * self.size
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        #: left * size + right of each pair that can merge, sorted, and the rank of what it merges to
        pairs = sorted((self.ranks[t[:i]] * self.size + self.ranks[t[i:]], rank) for t, rank in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks)
        self.keys, self.to = (np.array(x, np.int64) for x in zip(*pairs, (1 << 62, -1), strict=True))  # the last stands for none
        #: of ranks that may at once merge with a neighbour to something of lower rank
        self.may_fall = np.zeros(self.size, bool)
        for half in (self.keys // self.size, self.keys % self.size):
            self.may_fall[half[:-1][(self.to < half)[:-1]]] = True
        self.split, self.usual = regex.compile(pattern).findall, pattern == PATTERN
        self.known: dict[str, tuple[int, ...]] = {}

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What each pair merges to; -1 for none."""
        key = left * self.size + right
        at = self.keys.searchsorted(key)
        return np.where(self.keys[at] == key, self.to[at], -1)

    def _beside(self, token, after, before, rank, i, j):
        """Where the merges of i and j have neighbours, and the ranks of the pairs that they then make with them."""
        k, p = after[j], before[i]
        right, left = k >= 0, p >= 0
        own = token[p]
        beside = k[:-1] == i[1:]  # the left neighbour has just merged, to the same
        own[1:][beside] = rank[1:][beside]
        return right, left, self.rank_of(rank[right], token[k[right]]), self.rank_of(own[left], rank[left])

    def merged(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """The ids of each pre-token, all merged through one rank queue."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        total = int(sizes.sum())
        if not total:
            return [()] * len(words)
        token = self.single[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), sizes)
        after, before = np.arange(1, total + 1), np.arange(-1, total - 1)
        ends = np.cumsum(sizes)
        after[ends[sizes > 0] - 1] = -1
        before[(ends - sizes)[sizes > 0]] = -1
        queue = RankQueue(self.size)
        here = np.flatnonzero(after >= 0)
        ranks = self.rank_of(token[here], token[here + 1])
        here, ranks = here[ranks >= 0], ranks[ranks >= 0]
        order = np.argsort(ranks, kind="stable")
        here, ranks = here[order], ranks[order]
        first = np.flatnonzero(np.diff(ranks, prepend=-1))
        for rank, places in zip(ranks[first].tolist(), np.split(here, first[1:]) if len(first) else [], strict=True):
            queue.buckets[rank] = places.tolist()
            queue.mark(rank)
        least = np.full(len(words), self.size, np.int64)  # of each pre-token, the least rank among the entries taken
        while queue.top:
            rank, i = queue.pop_some(ALONE)
            j = after[i]
            live = self.rank_of(token[i], token[j]) == rank  # the others are stale: merged away (-1), last, or paired anew
            live &= j >= 0
            rank, i = rank[live], i[live]
            order = np.argsort(i, kind="stable")
            rank, i = rank[order], i[order]
            new = np.ones(len(i), bool)
            new[1:] = i[1:] != i[:-1]
            rank, i = rank[new], i[new]
            if not len(i):
                continue
            if rank[0] != rank[-1] or (rank != rank[0]).any():
                of = owner[i]
                np.minimum.at(least, of, rank)
                mine = rank == least[of]
                least[of] = self.size
                queue.push(rank[~mine], i[~mine])
                rank, i = rank[mine], i[mine]
            j = after[i]
            meets = j[:-1] == i[1:]
            if meets.any():  # in a chain of overlapping pairs every other one merges, from the left
                at = np.arange(len(i))
                take = (at - np.maximum.accumulate(np.where(np.concatenate([[False], meets]), 0, at))) % 2 == 0
                rank, i, j = rank[take], i[take], j[take]
            right, left, r, s = self._beside(token, after, before, rank, i, j)
            if self.may_fall[rank].any():
                fallen = np.zeros(len(i), bool)
                fallen[right] |= (r >= 0) & (r < rank[right])
                fallen[left] |= (s >= 0) & (s < rank[left])
                if fallen.any():  # a lower rank comes up: the leftmost of each pre-token alone
                    one = np.zeros(len(i), bool)
                    one[np.unique(owner[i], return_index=True)[1]] = True
                    queue.push(rank[~one], i[~one])
                    rank, i, j = rank[one], i[one], j[one]
                    right, left, r, s = self._beside(token, after, before, rank, i, j)
            token[i] = rank
            token[j] = -1
            k = after[j]
            after[i] = k
            before[k[right]] = i[right]
            queue.push(r, i[right])
            queue.push(s, before[i[left]])
        alive = token >= 0
        stops = np.cumsum(np.bincount(owner[alive], minlength=len(words))).tolist()
        every = token[alive].tolist()
        return [tuple(every[a:b]) for a, b in zip([0, *stops], stops, strict=False)]

    def pre_tokens(self, piece: str) -> list[str]:
        """The matches of the pattern in a piece of a text."""
        simple = self.usual and SIMPLE.fullmatch(piece, piece[:1] == " ")
        if simple:
            cut = simple.end(1)
            return [piece[:cut], piece[cut:]] if cut < len(piece) else [piece]
        return self.split(piece)

    def encode_chunks(self, texts: list[str]) -> list[tuple[int, ...]]:
        """The ids of texts, each split by the pattern; every pre-token that is not known yet goes through the rank queue."""
        parts = list(map(self.pre_tokens, texts))
        distinct = list(set(chain.from_iterable(parts)).difference(self.known))
        if len(self.known) + len(distinct) > CACHE:  # what came first is kept, for common pre-tokens come early
            self.known = dict(islice(self.known.items(), CACHE // 2)) if len(distinct) <= CACHE // 2 else {}
            distinct = list(set(chain.from_iterable(parts)).difference(self.known))
        ids = self.known
        ids.update(zip(distinct, self.merged([x.encode() for x in distinct]), strict=True))
        out = [tuple(chain.from_iterable(map(ids.__getitem__, x))) if len(x) != 1 else ids[x[0]] for x in parts]
        for x in distinct:
            if len(x) > LONGEST:
                del ids[x]
        return out

    def encode_keys(self, keys: list[str]) -> list[tuple[int, ...]]:
        """The ids of what :func:`chunks` gives."""
        return self.encode_chunks([x[1:] if x[:1] == "\0" else x if x[:1] == "\n" else " " + x for x in keys])

    def encode(self, text: str) -> list[int]:
        return list(self.encode_chunks([text])[0])

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def chunks(text: str) -> list[str]:
    """Keys of pieces of a text between which no match of the pattern lies.

    A match never crosses from a non-space into white space; a space between two non-spaces begins a match, and a line feed
    between two is one. So a text is cut before each such space or line feed. A key is the piece without its space, or with
    its line feed, or after a NUL any other piece. Texts with runs of white space, or with white space of another kind, are cut
    where that is sure, and otherwise kept whole.
    """
    if "  " in text or "\n\n" in text or " \n" in text or "\n " in text or "\0" in text or text[:1].isspace() or text[-1:].isspace() or any(map(text.__contains__, ASCII_SPACE if text.isascii() else OTHER_SPACE)):
        cuts = [0, *(m.start() for m in SURE.finditer(text)), len(text)]
        return ["\0" + text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    parts = text.replace("\n", " \n").split(" ")
    parts[0] = "\0" + parts[0]
    return parts


def _coder(path: str, pattern: str) -> ByteBPE:
    key = (path, pattern)
    if key not in _coders:
        _coders[key] = ByteBPE(path, pattern)
    return _coders[key]


_caches: dict[tuple, dict] = {}


def encode_decode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", pattern: str = PATTERN, keep_ids: bool = True) -> DataFrame:
    """(id_col, n_tokens, ids, decoded, ids_sha256, decoded_sha256) for each row; without ids and decoded if not ``keep_ids``.

    ``ids`` are the text's token ids, ``decoded`` the bytes that the ids stand for; the digests are of the decimal ids joined by
    a space and of the decoded bytes. Null counts as the empty text, which has no ids. Texts are whole at any length; repeated rows
    give repeated results; null ids stay; an empty table gives an empty result. Extra columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, cut = _coder(vocabulary, pattern), pattern == PATTERN
        cache = _caches.setdefault((vocabulary, pattern), {})
        names, pieces = [f" {i}" for i in range(coder.size)], coder.bytes_of
        encode = coder.encode_keys if cut else coder.encode_chunks

        def made(parts: list[str]) -> Iterator[tuple[str, bytes]]:
            """Of each chunk its ids in decimal, a space before each, and the bytes that the ids stand for."""
            return (("".join(map(names.__getitem__, x)), b"".join(map(pieces.__getitem__, x))) for x in encode(parts))

        for batch in slices(batches, TOGETHER):
            texts = [x or "" for x in batch.column(1).to_pylist()]
            n, ids, decoded, a, b = [], [], [], [], []
            for found in looked_up(texts, cache, made, chunks if cut else lambda x: [x], CACHE):
                decimal, back = (x.join(y) for x, y in zip(("", b""), zip(*found, strict=True), strict=True)) if found else ("", b"")
                n.append(decimal.count(" "))
                a.append(hashlib.sha256(decimal[1:].encode()).hexdigest())
                b.append(hashlib.sha256(back).hexdigest())
                if keep_ids:
                    ids.append(list(map(int, decimal.split())))
                    decoded.append(back)
            more = [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.binary())] if keep_ids else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), *more, pa.array(a, pa.string()), pa.array(b, pa.string())], names=["id", "n_tokens", *["ids", "decoded"][: len(more)], "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = "id long, n_tokens long, " + "ids array<int>, decoded binary, " * keep_ids + "ids_sha256 string, decoded_sha256 string"
    return map_batches(rows, run, schema).withColumnRenamed("id", id_col)
