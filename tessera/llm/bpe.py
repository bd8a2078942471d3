"""BPE encoding and decoding through a table of distinct words.

Every text is cut at ASCII white space, and its words before punctuation that ends them after an ASCII letter or digit. No
merge, no normalisation step and no pre-tokenizer match of the tokenizer crosses such a cut, so a text's ids are those of its
words, one after the other. That is so for the normalizer and pre-tokenizer below; with any other tokenizer file a whole
text is one word, which is right but saves only equal texts.

1. Documents are gathered, in scan order, into blocks of bounded characters and rows. A block holds each document as numbers
   into the list of the block's distinct words. Its id is that of its partition and its number in it.
2. The words go to partitions by their hash, a row for each block and partition; each distinct word of the corpus is encoded
   once there, and its ids return to (block, number).
3. Block and ids meet by the block's id; a document's ids are its words' ids by position. Decoding joins each id to its piece.

Texts cross the shuffle once, as compressed numbers, so the plan does not depend on the vocabulary's size. Step 1 runs in
both branches, over the same scan; should a second read give other blocks, step 3 finds another digest and says so.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tessera.llm.common import batched, release, text_batches, width

#: Characters (more only where one document is longer) and rows of a block.
BLOCK_CHARS, BLOCK_ROWS = 4_000_000, 100_000
#: Partitions that words are dealt to at most: a block gives a row for each, so more would cut the rows too small.
WORD_PARTS = 4096
#: Words whose ids a task keeps at a time; words that come later than that are encoded again.
KEPT_WORDS = 1_000_000
#: Words of documents that are joined to their ids at once.
JOINED_WORDS = 400_000

# The parts of a tokenizer file for which the cuts hold.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
_TAIL = ".,;:!?"
#: Characters below U+0100 that str.split() cuts at and the tokenizer may not.
_ODD = re.compile("[\x1c-\x1f\x85\xa0]")
_NONE = np.uint32(0xFFFFFFFF)


def words(text: str) -> list[str]:
    """The white-space pieces of a text. Up to U+00FF lower-casing goes letter by letter and no letter composes, so that
    such a text can be lower-cased before (but for the names of special tokens), which leaves fewer distinct words."""
    if not text.isascii():
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return [w for w in re.split("[ \t\n\r]+", text) if w]
    if "<|" in text or _ODD.search(text):
        return [w for w in re.split("[ \t\n\r]+", text) if w]
    return text.lower().split()


def parted(known: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Of distinct white-space pieces (words, the number of each piece's word, that of its punctuation or _NONE, which words
    are needed): the words are the pieces, in their order, and after them the parts that are no pieces themselves."""
    out, n = list(known), len(known)
    first, second, needed = np.arange(n, dtype=np.uint32), np.full(n, _NONE, np.uint32), np.ones(n, bool)
    cut = [(i, stem) for i, stem in ((i, w.rstrip(_TAIL)) for i, w in enumerate(known) if w[-1] in _TAIL) if stem and stem[-1].isascii() and stem[-1].isalnum()]
    if cut:
        table = dict(zip(known, range(n), strict=True))
        for i, stem in cut:
            w = known[i]
            for part, to in ((stem, first), (w[len(stem) :], second)):
                at = table.get(part)
                if at is None:
                    at = table[part] = len(out)
                    out.append(part)
                to[i] = at
            needed[i] = False
    return out, first, second, np.concatenate([needed, np.ones(len(out) - n, bool)])


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@lru_cache(maxsize=2)
def _spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def cutter(path: str) -> Callable[[str], list[str]]:
    """What cuts a text into words for this tokenizer file."""
    spec = _spec(path)
    plain = all(not t["normalized"] and not t["lstrip"] and not t["rstrip"] and not t["single_word"] and t["content"].startswith("<|") for t in spec["added_tokens"])
    return words if plain and (spec["normalizer"], spec["pre_tokenizer"]) == (NORMALIZER, PRE_TOKENIZER) else lambda text: [text] * bool(text)


@lru_cache(maxsize=2)
def pieces(path: str) -> pa.Array | None:
    """The id-to-piece table, each piece with a blank before it; None if the file has a decoder of its own."""
    if _spec(path)["decoder"] is not None:
        return None
    t = tokenizer(path)
    return pa.array([" " + (t.id_to_token(i) or "") for i in range(t.get_vocab_size(with_added_tokens=True))], pa.large_string())


def _blocks(batches: Iterator[pa.RecordBatch], chars: int, most: int) -> Iterator[tuple[int, list, list[str]]]:
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    keys, texts, size = [], [], 0
    for b in batches:
        for k, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            t = t.as_py() or ""
            keys.append(k)
            texts.append(t)
            size += len(t)
            if size >= chars or len(keys) >= most:
                yield number, keys, texts
                number += 1
                keys, texts, size = [], [], 0
    if keys:
        yield number, keys, texts


def _check(known: list[str]) -> int:
    return int.from_bytes(hashlib.blake2b("\n".join(known).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _parts(known: list[str], cut: Callable) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """`parted`, if this tokenizer's words may be; else every piece is a word."""
    n = len(known)
    return parted(known) if cut is words else (known, np.arange(n, dtype=np.uint32), np.full(n, _NONE, np.uint32), np.ones(n, bool))


def _squeeze(numbers: np.ndarray) -> bytes:
    """32-bit numbers by byte plane, compressed."""
    return zstandard.compress(np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _expand(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").reshape(-1)


def _block_rows(batches: Iterator[pa.RecordBatch], cut: Callable, chars: int, most: int) -> Iterator[tuple]:
    for block, keys, texts in _blocks(batches, chars, most):
        table: dict[str, int] = defaultdict()
        table.default_factory = table.__len__
        docs = [np.fromiter(map(table.__getitem__, w), np.uint32, len(w)) for w in map(cut, texts)]
        known, first, second, needed = _parts(list(table), cut)
        yield block, _check(known), int(needed.sum()), keys, [len(d) for d in docs], _squeeze(np.concatenate(docs)), _squeeze(first), _squeeze(second)


def _word_rows(batches: Iterator[pa.RecordBatch], cut: Callable, chars: int, most: int, parts: int) -> Iterator[tuple]:
    for block, _, texts in _blocks(batches, chars, most):
        pieces: dict[str, None] = {}
        for t in texts:
            pieces.update(dict.fromkeys(cut(t)))
        known, _, _, needed = _parts(list(pieces), cut)
        check = _check(known)
        raw = [w.encode("utf-8", "surrogatepass") for w in known]
        part = np.fromiter(map(zlib.crc32, raw), np.uint32, len(raw)) % np.uint32(parts)
        numbers = np.flatnonzero(needed)
        numbers = numbers[np.argsort(part[numbers], kind="stable")]
        cuts = np.flatnonzero(np.diff(part[numbers])) + 1
        for ns in np.split(numbers, cuts) if len(numbers) else []:
            yield block, check, int(part[ns[0]]), _squeeze(ns), zstandard.compress(_joined_words([raw[n] for n in ns.tolist()], cut), 1)


def _joined_words(raw: list[bytes], cut: Callable) -> bytes:
    """Words as bytes: a line each, or, as whole texts may have lines, each after its length."""
    return b"\n" + b"\n".join(raw) if cut is words else b"#" + b"".join(len(x).to_bytes(4, "little") + x for x in raw)


def _listed(held: bytes) -> list[str]:
    data = zstandard.decompress(held)
    if data[:1] == b"\n":
        return data[1:].decode("utf-8", "surrogatepass").split("\n")
    at, out = 1, []
    while at < len(data):
        n = int.from_bytes(data[at : at + 4], "little")
        out.append(data[at + 4 : at + 4 + n].decode("utf-8", "surrogatepass"))
        at += 4 + n
    return out


def _gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of flat from each start on, one after the other."""
    before = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else sizes
    return flat[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]


class _Encoded:
    """The ids of the words seen so far."""

    def __init__(self, path: str) -> None:
        t = tokenizer(path)
        self.encode = getattr(t, "encode_batch_fast", t.encode_batch)  # without offsets, which are not used here
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.starts, self.sizes, self.used = np.empty(1 << 16, "<u4"), np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64), 0

    def _room(self, name: str, n: int) -> np.ndarray:
        held = getattr(self, name)
        if n > len(held):
            setattr(self, name, np.concatenate([held, np.empty(max(n - len(held), len(held)), held.dtype)]))
        return getattr(self, name)

    def of(self, ws: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the words one after the other, how many each word has)."""
        if len(self.known) > KEPT_WORDS:
            self.clear()
        new = [w for w in ws if w not in self.known]
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            got = [e.ids for e in self.encode(part, add_special_tokens=False)]
            sizes, n = np.fromiter(map(len, got), np.int64, len(got)), len(self.known)
            total = int(sizes.sum())
            self._room("flat", self.used + total)[self.used : self.used + total] = np.fromiter(chain.from_iterable(got), "<u4", total)
            self._room("sizes", n + len(part))[n : n + len(part)] = sizes
            self._room("starts", n + len(part))[n : n + len(part)] = self.used + np.cumsum(sizes) - sizes
            self.known.update(zip(part, range(n, n + len(part)), strict=True))
            self.used += total
        at = np.fromiter(map(self.known.__getitem__, ws), np.int64, len(ws))
        return _gathered(self.flat, self.starts[at], self.sizes[at]), self.sizes[at]


def _encoded_rows(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple]:
    encoded = _Encoded(path)
    for b in batches:
        for block, check, ns, held in zip(*(c.to_pylist() for c in b.columns), strict=True):
            ids, sizes = encoded.of(_listed(held))
            yield block, check, ns, _squeeze(sizes), _squeeze(ids)


def _lists(ends: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int64)), values)


def _joined(lists: pa.Array) -> pa.Array:
    return pc.binary_join(lists, pa.scalar("" if pa.types.is_large_string(lists.type.value_type) else b"", lists.type.value_type))


def _join_back(path: str, out: pa.Schema):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        blocks = left.num_rows
        if not blocks:
            return pa.Table.from_batches([], schema=out)
        if blocks > 1:
            raise ValueError("two blocks of one id: the documents changed between two reads of one query; write them to a table first")
        _, check, n_words, keys, counts, numbers, first, second = (c[0].as_py() for c in left.columns)
        joined = lambda c: np.concatenate([_expand(x) for x in right.column(c).to_pylist()] or [np.empty(0, np.uint32)])
        number, size, flat = joined("ns").astype(np.int64), joined("lens").astype(np.int64), joined("ids")
        order = np.argsort(number, kind="stable")
        if len(number) != n_words or set(right.column("check").to_pylist()) - {check}:
            raise ValueError("the documents changed between two reads of one query; write them to a table first")
        flat, size = _gathered(flat, (np.cumsum(size) - size)[order], size[order]), size[order]
        ends = np.cumsum(size)
        ids = pa.Array.from_buffers(pa.large_binary(), n_words, [None, pa.py_buffer(np.concatenate([[0], 4 * ends]).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(flat, "<u4"))])
        table = pieces(path)
        # The id-to-piece join: ids are dense, so the lookup of a hash join is one by position.
        texts = _joined(_lists(ends, table.take(pa.array(flat.astype(np.int64))))) if table is not None else None
        every, first, second = _expand(numbers), _expand(first), _expand(second)
        more = second != _NONE
        second = np.where(more, second, 0)
        place = np.zeros(int(max(number.max(initial=0), first.max(initial=0), second.max(initial=0))) + 1, np.int64)
        place[number[order]] = np.arange(n_words)
        first, second = place[first], np.where(more, place[second], -1)
        sizes, done, at, word = np.array(counts, np.int64), [], 0, 0
        while at < len(keys):
            upto = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), JOINED_WORDS, "right")))
            n = int(sizes[at:upto].sum())
            piece = every[word : word + n]
            more = second[piece] >= 0
            places = np.cumsum(1 + more)
            by_word = np.repeat(first[piece], 1 + more)
            by_word[places[more] - 1] = second[piece][more]
            doc_ends = np.concatenate([[0], places])[np.cumsum(sizes[at:upto])]
            take = pa.array(by_word)
            own = _joined(_lists(doc_ends, ids.take(take)))
            if texts is not None:
                decoded = pc.utf8_slice_codeunits(_joined(_lists(doc_ends, texts.take(take))), 1).cast(pa.string())
            else:
                decoded = pa.array([tokenizer(path).decode(np.frombuffer(x.as_py(), "<u4").tolist(), skip_special_tokens=False) for x in own], pa.string())
            done.append(pa.RecordBatch.from_arrays([pa.array(keys[at:upto], out.field("key").type), own.cast(pa.binary()), decoded], schema=out))
            at, word = upto, word + n
        release()
        return pa.Table.from_batches(done, schema=out)

    return run


def encode_decode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's key, its ids as little-endian 32-bit numbers (`ids`) and the text that they decode to (`decoded`).

    One row per row of docs, repeated keys and null keys included. A null or empty text has no ids and decodes to "".
    Other columns are not read. docs must give the same rows in the same partitions and order when read again, as files and
    stored tables do; else the query fails and says so.
    """
    text_batches(docs.sparkSession)
    kind = docs.schema[key].dataType
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    a = pa.schema([("block", pa.int64()), ("check", pa.int64()), ("n_words", pa.int32()), ("keys", pa.list_(to_arrow_type(kind))), ("counts", pa.list_(pa.int32())), ("numbers", pa.binary()), ("first", pa.binary()), ("second", pa.binary())])
    b = pa.schema([("block", pa.int64()), ("check", pa.int64()), ("part", pa.int32()), ("ns", pa.binary()), ("words", pa.binary())])
    c = pa.schema([("block", pa.int64()), ("check", pa.int64()), ("ns", pa.binary()), ("lens", pa.binary()), ("ids", pa.binary())])
    out = pa.schema([("key", to_arrow_type(kind)), ("ids", pa.binary()), ("decoded", pa.string())])
    wide, chars, most, cut = width(docs), BLOCK_CHARS, BLOCK_ROWS, cutter(path)
    parts = min(wide, WORD_PARTS)
    block_type = T.StructType([T.StructField("block", T.LongType()), T.StructField("check", T.LongType()), T.StructField("n_words", T.IntegerType()), T.StructField("keys", T.ArrayType(kind)), T.StructField("counts", T.ArrayType(T.IntegerType())), *(T.StructField(x, T.BinaryType()) for x in ("numbers", "first", "second"))])
    blocks = docs.mapInArrow(batched(lambda x: _block_rows(x, cut, chars, most), a, rows=1), block_type)
    spread = docs.mapInArrow(batched(lambda x: _word_rows(x, cut, chars, most, parts), b), "block long, check long, part int, ns binary, words binary").repartition(parts, "part")
    known = spread.select("block", "check", "ns", "words").mapInArrow(batched(lambda x: _encoded_rows(x, path), c), "block long, check long, ns binary, lens binary, ids binary")
    joined = blocks.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(_join_back(path, out), T.StructType([T.StructField("key", kind), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())]))
    return joined.withColumnRenamed("key", key)
