import hashlib
import random
import struct

import pytest

from tessera.llm import bpe, queries

EDGE = [
    None, "", " ", "\n\n\t", "Hello, World.", "it's we'll  I'D", "word., end... (a) b).", "A<|endoftext|>B <|STARTOFTEXT|> <|startoftext|>.",
    "café, café naïve. Å ẛ̣.", "x\u0085y z w\x1cq", "İstanbul ΣΑΣ Σ", "İ. İ! aİ,", "漢字かな交じり文。テスト", "1,234.5 ³⁴ Ⅷ. ²,", "🙂🙂 👩‍👩‍👧!",
    "the " * 5000, "a" * 3000, "\u0000 nul", "tail.", "tail?!", "́start", "don't, 'S. x'll!", "...", "é. É, ́",
]


def expected(text):
    t = bpe.tokenizer(queries.tokenizer_path())
    ids = t.encode(text or "", add_special_tokens=False).ids
    return struct.pack(f"<{len(ids)}I", *ids), t.decode(ids, skip_special_tokens=False)


def run(spark, rows, path=None):
    docs = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, ids string").repartition(3)
    return sorted(((r.doc_id, bytes(r.ids), r.decoded) for r in bpe.encode_decode(docs, path or queries.tokenizer_path()).collect()), key=repr)


def test_matches_the_library(spark):
    rows = [*enumerate(EDGE), (0, "again"), (0, "again"), (None, "no key"), (None, None)]
    # The library takes no lone surrogates, and Spark holds none.
    assert run(spark, rows) == sorted(((k, *expected(t)) for k, t in rows), key=repr)


@pytest.mark.parametrize(("chars", "most"), [(500, 10**6), (10**9, 3)])
def test_small_blocks_give_the_same(spark, sf, monkeypatch, chars, most):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", chars)
    monkeypatch.setattr(bpe, "BLOCK_ROWS", most)
    monkeypatch.setattr(bpe, "JOINED_WORDS", 50)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").limit(40).collect()] + [(9_000 + i, "") for i in range(20)]
    assert run(spark, rows) == sorted(((k, *expected(t)) for k, t in rows), key=repr)


def test_words_are_kept_or_encoded_again(monkeypatch):
    texts = [w for w in EDGE if w and w.strip()]
    t = bpe.tokenizer(queries.tokenizer_path())
    for most in (2, 10**6):
        monkeypatch.setattr(bpe, "KEPT_WORDS", most)
        held = bpe._Encoded(queries.tokenizer_path())
        for _ in range(2):
            for at in range(0, len(texts), 3):
                ids, sizes = held.of(texts[at : at + 3])
                want = [t.encode(x, add_special_tokens=False).ids for x in texts[at : at + 3]]
                assert ids.tolist() == sum(want, []) and sizes.tolist() == list(map(len, want))


def test_equal_blocks_stay_apart(spark):
    """Blocks of equal content, as of empty texts, have ids of their own, so that no task gets them all."""
    docs = spark.createDataFrame([(i, "") for i in range(1000)], "key long, text string").repartition(4)
    got = docs.mapInArrow(bpe.batched(lambda b: ((n,) for n, *_ in bpe._blocks(b, 10**9, 100)), bpe.pa.schema([("n", bpe.pa.int64())])), "n long").collect()
    assert len({r.n for r in got}) == len(got) >= 10


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id string, text string")
    assert bpe.encode_decode(docs, queries.tokenizer_path()).collect() == []


def by_words(text):
    t = bpe.tokenizer(queries.tokenizer_path())
    pieces = bpe.words(text)
    known = list(dict.fromkeys(pieces))
    distinct, first, second, needed = bpe.parted(known)
    numbers = [i for p in pieces for i in (first[known.index(p)], second[known.index(p)]) if i != bpe._NONE]
    assert len(set(distinct)) == len(distinct) == len(needed) and all(needed[i] for i in numbers)
    parts = [distinct[i] for i in numbers]
    return [i for w in parts for i in t.encode(w, add_special_tokens=False).ids]


@pytest.mark.parametrize("text", [t for t in EDGE if t])
def test_cuts_are_safe(text):
    assert by_words(text) == bpe.tokenizer(queries.tokenizer_path()).encode(text, add_special_tokens=False).ids


def test_cuts_are_safe_around_every_letter():
    """Every code point below U+0250, and some beyond, before, after and between punctuation."""
    t = bpe.tokenizer(queries.tokenizer_path())
    for cp in [*range(1, 0x250), 0x300, 0x307, 0x3A3, 0x1E9E, 0x2028, 0x212A, 0xFB01, 0x1D400]:
        for text in (f"{chr(cp)}.", f"a{chr(cp)}, b", f"x {chr(cp)}{chr(cp)}!? .{chr(cp)} '{chr(cp)}.", f"{chr(cp)}̇;"):
            assert by_words(text) == t.encode(text, add_special_tokens=False).ids, hex(cp)


def test_cuts_are_safe_in_random_texts():
    r, t = random.Random(3), bpe.tokenizer(queries.tokenizer_path())
    for _ in range(4000):
        text = "".join(r.choice("aZé İıßſḰ̇'.,;:!?<|>\n\t 09²\xa0 sStTdD漢") for _ in range(r.randint(1, 12)))
        assert by_words(text) == t.encode(text, add_special_tokens=False).ids, repr(text)


def test_other_tokenizers_take_whole_texts(spark):
    path = queries.tokenizer_path("byte_bpe_50k.json")
    t = bpe.tokenizer(path)
    rows = [(1, "Hello, World.  two"), (2, "é 漢字"), (3, None), (1, "Hello, World.  two")]
    ids = [t.encode(x or "", add_special_tokens=False).ids for _, x in rows]
    assert run(spark, rows, path) == sorted(((k, struct.pack(f"<{len(i)}I", *i), t.decode(i, skip_special_tokens=False)) for (k, _), i in zip(rows, ids, strict=True)), key=repr)


def test_query(spark, sf):
    got = {r.doc_id: r for r in queries.op1_bpe(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids, text = expected(d.text)
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
