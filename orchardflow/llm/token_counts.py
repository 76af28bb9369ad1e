"""Token counts by map-side lookup in two tiers.

The tokenizer of a ``.json`` file normalises character by character and never lets a token cross a pre-token's end, so a text's count is
the sum over its pre-tokens. Tier one is a broadcast table of the corpus's most frequent pre-tokens with their lengths; tier two is caches in each
worker: of the other pre-tokens, and of sums over what stands between two spaces, so that most of a text needs no splitting.
Pre-tokens themselves are never shuffled: choosing the frequent ones takes a bounded summary from each task.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchardflow.llm._common import map_batches, slices

#: Most entries of each of a worker's caches. Only speed depends on it.
CACHE = 1_000_000
#: Longest chunk that is kept in a cache or table.
LONGEST = 64
_loaded: dict[str, object] = {}
_caches: dict[tuple, dict] = {}


def tokenizer(path: str):
    """The tokenizer of a vocabulary file, loaded once a worker."""
    if path not in _loaded:
        if path.endswith(".model"):
            import sentencepiece

            _loaded[path] = sentencepiece.SentencePieceProcessor(model_file=path)
        else:
            from tokenizers import Tokenizer

            found = Tokenizer.from_file(path)
            found.no_truncation()
            found.no_padding()
            _loaded[path] = found
    return _loaded[path]


def encode_all(path: str, texts: list[str]) -> list[list[int]]:
    """The library's ids of each text, without added special tokens, on one thread."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    found = tokenizer(path)
    if path.endswith(".model"):
        return found.encode(texts, num_threads=1)
    return [x.ids for x in found.encode_batch_fast(texts, add_special_tokens=False)]


def chunks(text: str) -> list[str]:
    """The chunks between spaces and line feeds; both are white space to the tokenizer, and no token holds white space.

    Lower case comes first, as the tokenizer's normaliser has it by the character. Texts with a special string, or with the
    letter whose lower case depends on its neighbours, stay as they are: the library then sees each chunk unchanged.
    """
    if "<|" not in text and "\u03a3" not in text:
        text = text.lower()
    return text.replace("\n", " ").split(" ")


def _kind(path: str) -> dict:
    import json

    return json.loads(tokenizer(path).to_str())


def separable(path: str) -> bool:
    """Whether a text's tokens are those of its chunks one after another: the word vocabulary drops white space and normalises by the character."""
    if path.endswith(".model"):
        return False
    kind = _kind(path)
    split = (kind.get("pre_tokenizer") or {}).get("pretokenizers") or [kind.get("pre_tokenizer") or {}]
    return bool(split[0].get("type") == "Split" and split[0].get("behavior") == "Removed" and split[0].get("invert") and not kind.get("post_processor"))


#: Chunks of letters, with one mark at most after them, need no splitting; those of other plain characters are split by the vocabulary's own
#: pattern. Anything else (combining marks, other scripts, control characters) goes to the library as it is.
SIMPLE = re.compile("([A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-/:-@[-`{-~]?)")
PLAIN = re.compile("[!-~\u00a1-\u00ac\u00ae-\u024f]+")


class WordCoder:
    """The ids of chunks of a separable vocabulary, through a cache of the ids of pre-tokens.

    ``value`` makes of the ids of a pre-token (four bytes each) what is kept, and ``add`` joins the values of a chunk's pre-tokens. ``table`` has values
    known beforehand.
    """

    def __init__(self, path: str, value=bytes, add=b"".join, table: dict | None = None) -> None:
        self.path, self.value, self.add = path, value, add
        self.table = table or {}
        self.known: dict = dict(self.table)
        kind = _kind(path)
        split = kind["pre_tokenizer"].get("pretokenizers") or [kind["pre_tokenizer"]]
        self.split = regex.compile(split[0]["pattern"]["Regex"]).findall
        suffix = kind["model"].get("end_of_word_suffix")
        vocabulary = tokenizer(path).get_vocab()
        #: of token ids that end a pre-token
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def pre_tokens(self, chunk: str) -> list[str] | None:
        """The chunk's pre-tokens, None where the library has to see the whole chunk."""
        simple = SIMPLE.fullmatch(chunk)
        if simple:
            cut = simple.end(1)
            return [chunk] if cut == len(chunk) else [chunk[:cut], chunk[cut:]]
        return self.split(chunk) if PLAIN.fullmatch(chunk) and "<|" not in chunk else None

    def encoded(self, words: list[str]) -> list[bytes]:
        """The ids of each pre-token, many encoded as one text and told apart by the tokens that end a word."""
        out: list[bytes] = []
        for at in range(0, len(words), 4096):
            group = words[at : at + 4096]
            ids = np.array(encode_all(self.path, [" ".join(group)])[0], np.uint32)
            stops = 4 * (np.flatnonzero(self.ends[ids]) + 1)
            if len(stops) == len(group) and stops[-1] == 4 * len(ids):
                raw, stops = ids.tobytes(), stops.tolist()
                out += [raw[a:b] for a, b in zip([0, *stops], stops, strict=False)]
            else:
                out += [np.array(x, np.uint32).tobytes() for x in encode_all(self.path, group)]
        return out

    def chunk_values(self, parts: list[str]) -> list:
        split = [self.pre_tokens(x) if x else [] for x in parts]
        new = set().union(*filter(None, split)).difference(self.known)
        if len(self.known) + len(new) > CACHE:
            self.known = dict(islice(self.known.items(), CACHE // 2)) if len(new) <= CACHE // 2 else dict(self.table)
            new = set().union(*filter(None, split)).difference(self.known)
        new = list(new)
        known = self.known
        known.update(zip(new, map(self.value, self.encoded(new)), strict=True))
        odd = [x for x, y in zip(parts, split, strict=True) if y is None]
        whole = iter([self.value(np.array(x, np.uint32).tobytes()) for x in encode_all(self.path, odd)])
        out = [next(whole) if y is None else known[y[0]] if len(y) == 1 else self.add(map(known.__getitem__, y)) for y in split]
        for x in new:
            if len(x) > LONGEST:
                del known[x]
        return out


def looked_up(texts: list[str], cache: dict, make, split=chunks, most: int = CACHE) -> list[list]:
    """For each text the cached values of its chunks; ``make`` gives the values of the chunks that the cache lacks.

    A full cache keeps what came first, for common chunks come early. Only speed depends on what is kept.
    """
    parts = [split(x) for x in texts]
    missing = set().union(*parts).difference(cache) if parts else set()
    if missing:
        if len(cache) + len(missing) > most:
            kept = list(islice(cache.items(), most // 2))
            cache.clear()
            cache.update(kept if len(missing) <= most // 2 else ())
            missing = set().union(*parts).difference(cache)
        ordered = list(missing)
        cache.update(zip(ordered, make(ordered), strict=True))
    get = cache.__getitem__
    values = [list(map(get, x)) for x in parts]
    for x in missing:
        if len(x) > LONGEST:
            del cache[x]
    return values


def frequent_pre_tokens(docs: DataFrame, vocabulary: str, text_col: str = "text", size: int = 16384, each: int = 2048) -> list[str]:
    """The pre-tokens that occur most in all texts: at most ``size``, from at most ``each`` of a task.

    Every text is counted. A task keeps a summary of bounded size, in which rare chunks may be dropped as it fills: counts
    may be low, which changes the speed of look-ups but no result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(vocabulary, "split")
        seen: Counter = Counter()
        for batch in slices(batches, 64):
            for text in batch.column(0).to_pylist():
                seen.update(chunks(text or ""))
            if len(seen) > 120_000:
                seen = Counter(dict(seen.most_common(20_000)))
        words: Counter = Counter()
        for chunk, n in seen.most_common(20_000):
            for x in coder.pre_tokens(chunk) or () if chunk else ():
                words[x] += n
        top = [(k, n) for k, n in words.most_common(each) if len(k) <= LONGEST]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["word", "n"])

    summary = map_batches(docs.select(F.col(text_col).cast("string").alias("text")), run, "word string, n long")
    top = summary.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(size)
    return [r.word for r in top.collect()]


_coders: dict[tuple[str, str], WordCoder] = {}


def _coder(path: str, kind: str, **more) -> WordCoder:
    """A worker's coder for a vocabulary and a kind of value."""
    if (path, kind) not in _coders:
        _coders[path, kind] = WordCoder(path, **more)
    return _coders[path, kind]


def chunk_ids(path: str, parts: list[str]) -> list[bytes]:
    """The ids of each chunk of a separable vocabulary, four bytes a token."""
    return _coder(path, "ids").chunk_values(parts)


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048, table_size: int = 16384) -> DataFrame:
    """(id_col, n_bytes, n_tokens, over_limit) for each row: UTF-8 bytes, tokens as the library gives them, and n_tokens > ``limit``.

    Null counts as empty: no bytes, no tokens. Texts are whole at any length; repeated rows count each; a null id is kept;
    an empty table gives an empty result. Extra columns are ignored. ``vocabulary`` is a path that workers can read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    split = separable(vocabulary)
    words: list[str] = frequent_pre_tokens(rows, vocabulary, "text", table_size) if split else []
    lengths = np.array([len(x) >> 2 for x in WordCoder(vocabulary).encoded(words)] if split else [], np.uint16)
    # compact: the words end to end and their lengths in two bytes each, of at most table_size words of at most LONGEST characters
    table = docs.sparkSession.sparkContext.broadcast((" ".join(words).encode(), lengths.tobytes()))

    def frequent() -> dict[str, int]:
        joined, lengths = table.value
        return dict(zip(joined.decode().split(" "), np.frombuffer(lengths, np.uint16).tolist(), strict=True)) if joined else {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(vocabulary, "counts", value=lambda ids: len(ids) >> 2, add=sum, table=frequent()) if split else None
        cache = _caches.setdefault(("counts", vocabulary), {})
        for batch in slices(batches):
            texts = [x or "" for x in batch.column(1).to_pylist()]
            found = list(map(sum, looked_up(texts, cache, coder.chunk_values))) if split else [len(x) for x in encode_all(vocabulary, texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.int64())], ["id", "n_bytes", "n_tokens"])

    counted = map_batches(rows.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")).select("id", "text", "n_bytes"), run, "id long, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
