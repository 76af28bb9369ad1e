"""Byte-level BPE, token counts, SimHash and packing against brute force on small tables."""

import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from tokenizers import Tokenizer

from orchardflow.llm import bpe, packing, simhash, token_counts

BYTE = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " ", "\n", "a", " a  b\n\nc \n d\t\te ", "<|endoftext|>x <|startoftext|>", "Ünïcödé ΣΑΣ don't İstanbul 漢字🙂 é", "x\0y \0z", "ab" * 3000, "a" * 5001, " " * 300 + "b", "word next end\x1c!"]


def table(spark, texts, extra=True):
    rows = [(i if i != 3 else None, x, i, "clash", 7) for i, x in enumerate(texts)] + [(0, texts[0], 0, "again", 7)] * (len(texts) > 0)
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens long, fp string, id int").repartition(3)


def texts(n=60):
    rng = random.Random(3)
    words = ["the", "of", "ation", "Über", "thing,", "x1", "don't", "\n", "eau.", "SH!!", "ñandú", "***"]
    return ODD + [" ".join(rng.choice(words) + rng.choice(["", "s", "ing"]) for _ in range(rng.randint(0, 90))) for _ in range(n)]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTE, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_like_library(spark, reference):
    df = table(spark, texts())
    got = sorted(bpe.encode_decode(df, BYTE).collect(), key=lambda r: r.ids_sha256)
    want = []
    for r in df.collect():
        ids = reference.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), ids, (r.text or "").encode(), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()))
    want.sort(key=lambda r: r[4])
    assert [(r.n_tokens, list(r.ids), bytes(r.decoded), r.ids_sha256) for r in got] == [x[1:] for x in want]
    assert sorted(str(r.doc_id) for r in got) == sorted(str(x[0]) for x in want)
    assert bpe.encode_decode(df.limit(0), BYTE).count() == 0


def test_rank_queue_random_strings(reference):
    rng = random.Random(5)
    coder = bpe.ByteBPE(BYTE)
    for _ in range(3000):
        x = "".join(rng.choice("aabetn \n\t'sll!é0🙂 \x85") for _ in range(rng.randint(0, 40)))
        assert coder.encode(x) == reference.encode_ordinary(x)
        assert [i for part in coder.encode_keys(bpe.chunks(x)) for i in part] == reference.encode_ordinary(x)
    assert coder.decode(coder.encode("né 漢")) == "né 漢".encode()


def test_rank_queue_falling_ranks(tmp_path):
    """A vocabulary in which a merge may make a lower rank than itself."""
    tokens = [bytes([i]) for i in range(256)] + [b"abc", b"ab", b"bd", b"abcab", b"aa", b"aaaa", b"ca"]
    path = tmp_path / "v.tiktoken"
    path.write_text("\n".join(f"{base64.b64encode(x).decode()} {i}" for i, x in enumerate(tokens)))
    coder = bpe.ByteBPE(str(path))
    library = tiktoken.Encoding("v", pat_str=bpe.PATTERN, mergeable_ranks={x: i for i, x in enumerate(tokens)}, special_tokens={})
    rng = random.Random(6)
    for _ in range(2000):
        x = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 25)))
        assert coder.encode(x) == library.encode_ordinary(x), x


def test_token_counts_like_library(spark):
    tok = Tokenizer.from_file(WORD)
    df = table(spark, texts())
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(df, WORD, limit=50).collect())
    n = [(r, len(tok.encode(r.text or "", add_special_tokens=False).ids)) for r in df.collect()]
    assert got == sorted((str(r.doc_id), len((r.text or "").encode()), k, k > 50) for r, k in n)
    assert token_counts.token_counts(df.limit(0), WORD).count() == 0
    wide = "".join(chr(c) for c in range(1, 0x2FF)) + " " + " ".join(chr(c) + "x" + chr(c) for c in range(1, 0x5FF))
    assert sum(map(len, token_counts.encode_all(WORD, token_counts.chunks(wide)))) == len(tok.encode(wide, add_special_tokens=False).ids)


def test_token_counts_other_vocabulary(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    df = table(spark, ["a b", None, "Hello  there"])
    got = sorted((r.n_bytes, r.n_tokens) for r in token_counts.token_counts(df, path).collect())
    assert got == sorted((len((r.text or "").encode()), len(model.encode(r.text or ""))) for r in df.collect())


def brute_fingerprint(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, prints, bits=2):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, x in enumerate(ids):
        if x is not None:
            least[find(i)].append(x)
    return [min(least[find(i)], default=None) for i in range(len(ids))]


def test_simhash_components(spark):
    rng = random.Random(4)
    base = [" ".join(rng.choice("alpha beta gamma delta eps zeta eta".split()) for _ in range(300)) for _ in range(8)]
    near = []
    for x in base:
        for _ in range(8):
            w = x.split()
            w[rng.randrange(len(w))] = "changed"
            near.append(" ".join(w))
    df = table(spark, texts(20) + base + near + near[:3])
    rows = df.collect()
    prints = [brute_fingerprint(r.text) for r in rows]
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.near_duplicates(df).collect())
    want = brute_components([r.doc_id for r in rows], prints)
    assert got == sorted((str(r.doc_id), f"{p:016x}", str(c)) for r, p, c in zip(rows, prints, want, strict=True))
    assert len({x[2] for x in got}) < len(rows) - 20
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_simhash_dense_points():
    rng = np.random.default_rng(2)
    centre = rng.integers(0, 1 << 63, 4, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (4, 90, 3)).astype(np.uint64)
    found = np.unique((centre[:, None, None] ^ flips).ravel() ^ np.repeat(flips[..., ::-1].ravel()[:1080], 1))
    a, b = simhash.linked(found)
    small = brute_components(list(range(len(found))), [int(x) for x in found])
    place = {int(x): i for i, x in enumerate(found)}
    root = list(range(len(found)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        assert find(place[x]) is not None
        root[max(find(place[x]), find(place[y]))] = min(find(place[x]), find(place[y]))
    assert len(found) > simhash.DENSE and [find(i) for i in range(len(found))] == small


def test_packing_places_every_id_once(spark):
    tok = Tokenizer.from_file(WORD)
    df = table(spark, texts() + ["long word here " * 3000])
    pieces = packing.pack(df, WORD).collect()
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in pieces:
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        sequences[r.sequence_id].append(r)
        documents[r.doc_id].append(r)
    for rows in sequences.values():
        rows.sort(key=lambda r: r.offset)
        assert [r.offset for r in rows] == [sum(x.length for x in rows[:i]) for i in range(len(rows))]
        total = sum(r.length for r in rows)
        assert total <= 2048 and (total & (total - 1)) == 0
    want = defaultdict(list)
    for r in df.collect():
        want[r.doc_id].append(tok.encode(r.text or "", add_special_tokens=False).ids + [1])
    assert sum(r.length for r in pieces) == sum(len(x) for ids in want.values() for x in ids)
    for k, ids in want.items():
        if len(ids) == 1:
            rows = sorted(documents[k], key=lambda r: r.start)
            assert [i for r in rows for i in r.ids] == ids[0] and {r.doc_tokens for r in rows} == {len(ids[0])}
    assert packing.pack(df.limit(0), WORD).count() == 0


def test_step_groups_are_balanced_and_padding_is_small():
    """Sequences go to the lightest open group; full groups differ by less than a sequence, and tails are cut at powers of two."""
    rng = random.Random(3)
    packer = packing.Packer(2048, 0)
    sizes = [rng.choice([3, 40, 300, 900, 2047, 2048, 5000, 17_000]) for _ in range(1500)]
    for i, n in enumerate(sizes):
        packer.add(i, bytes(4 * n))
    packer.pack(last=True)
    sequences, groups = {}, {}
    for _, _, n, _, _, sequence, offset, length, group, _ in packer.rows:
        assert sequences.setdefault(sequence, [0, length, group])[0] == offset
        sequences[sequence][0] += n
    assert sum(n for n, *_ in sequences.values()) == sum(sizes)
    assert all(n == length and (n == 2048 or n & (n - 1) == 0) for n, length, _ in sequences.values())
    for n, _, group in sequences.values():
        groups[group] = groups.get(group, 0) + n
    full = [n for n in groups.values() if n >= packer.step_tokens]
    assert len(full) > 3 and max(full) - min(full) < 2048 and sum(n < packer.step_tokens for n in groups.values()) <= len(packer.groups)
