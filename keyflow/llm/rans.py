"""Token ids in files coded by a static range asymmetric numeral system.

Documents are sorted by id over the cluster; each task tokenises its range and
writes one file of segments. A segment has one frequency table, counted over all
its tokens and shared by its blocks; a block codes ``BLOCK`` tokens on ``LANES``
interleaved states and stands alone: the segment's index holds, as checkpoints,
where each block starts, its tokens, its first states and a checksum of its ids.
Blocks of a segment are coded and decoded side by side in numpy, and segments in
parallel by Spark.

Tokenising: a text whose words are parted by single blanks or line ends is cut
there, where no pre-token reaches across. Arrow splits and numbers the words of a
batch; the library encodes each distinct word that the worker has not met, and
ids are placed with numpy. Any other text goes to the library whole.

The catalogue, a row per segment with its documents, is written beside the files
as Parquet: ``open_tokens`` finds it in any session.

Defined results: null text counts as empty and has only the end id; a null id
sorts first; repeated ids stay, ordered by text hash; an empty table gives no
file and no rows.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keyflow.llm import files
from keyflow.llm.common import load_table, shared_folder, ship_package, text_of, written

BLOCK, LANES = 1 << 15, 32
SEGMENT = 1 << 22      # tokens
MEMO = 1_000_000       # words that a worker keeps; a full table starts anew
SLICE = 4 << 20        # bytes of texts that are tokenised at once, if there are several
SEGMENT_DOCS = 1 << 18
START = "\r"           # before the first word of a text
LOW = 1 << 31          # states stay in [LOW, LOW << 32)
MAGIC = b"RANSTOK1"
SPECIAL = "<|endoftext|>"


# The byte-level alphabet writes printable bytes as they are, all others as letters from 256 on.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_LEVEL = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTED)}
del _BYTE_LEVEL[10]    # no word holds a line end: it parts them
_ID = attrgetter("id")
# texts with any of these go to the library whole: blanks that are not single, other white space, the special token
_UNEVEN = (r"^[ \n]|[ \n][ \n]|[ \n]$|[\t\x0b\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
           r"\x{202f}\x{205f}\x{3000}]|" + re.escape(SPECIAL))


class WordTokens:
    """Ids of texts by the tokenizers library.

    Words are known by their form: a word as it is stands after a blank, one with a
    line end before it begins a line, one with START before it begins a text.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        line = self._ids("\n")
        self.line = line[0] if len(line) == 1 else None
        self.line_bytes = np.array(line, np.uint32).tobytes()
        # signs that are a pre-token of their own after a letter
        self.signs = {}
        for sign in ".,;:!?":
            own = self._ids(sign)
            if all(self._ids(w + sign) == self._ids(w) + own for w in (" ab", "ab", " \u00e9\u00e9", "K")):
                self.signs[sign] = np.array(own, np.uint32).tobytes()
        # a word of letters is one pre-token: the library's model takes it at once, if it is of the byte-level kind
        self.model = self.lib.model
        probes = ["the", "\u00e9t\u00e9", "K\u00e4se", "\u65e5\u672c", "unmentioned"]
        self.direct = all(self._letters(probes, b) == [np.array(self._ids(b + w), np.uint32).tobytes() for w in probes]
                          for b in ("", " "))

    def _ids(self, text: str) -> list[int]:
        return self.lib.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _letters(self, words: list[str], blank: str) -> list[bytes]:
        """Words that are one pre-token each, by the model alone."""
        begin = blank.translate(_BYTE_LEVEL)
        wide = [w for w in words if not w.isascii()]
        mapped = dict(zip(wide, "\n".join(wide).encode().decode("latin-1").translate(_BYTE_LEVEL).split("\n"), strict=False))
        tokenize = self.model.tokenize
        return [array("I", map(_ID, tokenize(begin + mapped.get(w, w)))).tobytes() for w in words]

    def _many(self, words: list[str], blank: str) -> list[bytes]:
        """Words without white space: letters one by one, others in one call for many, parted by line ends."""
        if not self.direct:
            return self._joined(words, blank)
        plain, other = [w for w in words if w.isalpha()], [w for w in words if not w.isalpha()]
        found = dict(zip(chain(plain, other), chain(self._letters(plain, blank), self._joined(other, blank)), strict=True))
        return [found[w] for w in words]

    def _joined(self, words: list[str], blank: str) -> list[bytes]:
        out = []
        for at in range(0, len(words), 5000):
            some = words[at:at + 5000]
            ids = np.array(self._ids(blank + f"\n{blank}".join(some)), np.uint32)
            ends = np.flatnonzero(ids == self.line)
            if len(ends) == len(some) - 1:
                raw = ids.tobytes()
                begin, end = [0, *(4 * ends + 4).tolist()], [*(4 * ends).tolist(), len(raw)]
                out += [raw[i:k] for i, k in zip(begin, end, strict=True)]
            else:
                out += [np.array(self._ids(blank + w), np.uint32).tobytes() for w in some]
        return out

    def _learn(self, forms: list[str]) -> None:
        """Encode new forms; a word and the sign after it are looked up apart."""
        known, signs = self.known, self.signs
        cut = {f: f[:-1] for f in forms if f[-1:] in signs and f[-2:-1].isalpha()}
        new = dict.fromkeys(f for f in chain((f for f in forms if f not in cut), cut.values()) if f not in known)
        first = [f for f in new if f[:1] in (START, "\n")]
        spaced = [f for f in new if f[:1] not in (START, "\n")]
        known.update(zip(spaced, self._many(spaced, " "), strict=True))
        for f, ids in zip(first, self._many([f[1:] for f in first], ""), strict=True):
            known[f] = self.line_bytes + ids if f[0] == "\n" else ids
        known.update((f, known[w] + signs[f[-1]]) for f, w in cut.items())

    def _placed(self, rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows (forms parted by blanks), and how many each row has."""
        parts = pc.split_pattern(rows, " ")
        words = parts.flatten().dictionary_encode()
        forms = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) + len(forms) > MEMO:
            self.known.clear()
        unknown = [f for f in forms if f not in self.known]
        if unknown:
            self._learn(unknown)
        packed = list(map(self.known.__getitem__, forms))
        size = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        begin = np.cumsum(size) - size
        buffer = np.frombuffer(b"".join(packed), np.uint32)
        code = words.indices.to_numpy(zero_copy_only=False)
        many = size[code]
        ends = np.cumsum(many)
        at = np.repeat(begin[code] - (ends - many), many) + np.arange(ends[-1])
        row_ends = np.append(0, ends)[np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))]
        return buffer[at], np.diff(row_ends, prepend=0)

    def _long(self, text: str) -> np.ndarray:
        """A very long text, cut between words."""
        forms, at, parts = START + text.replace("\n", " \n"), 0, []
        while at < len(forms):
            stop = forms.find(" ", at + SLICE)
            stop = len(forms) if stop < 0 else stop
            parts.append(self._placed(pa.array([forms[at:stop]], pa.large_string()))[0])
            at = stop + 1
        return np.concatenate(parts)

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each text has."""
        n = len(texts)
        texts = texts.cast(pa.large_string())
        length = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        whole = pc.match_substring_regex(texts, _UNEVEN).to_numpy(zero_copy_only=False) | (self.line is None)
        even = np.flatnonzero(~whole & (length > 0) & (length <= 4 * SLICE))
        sizes, found = np.zeros(n, np.int64), [None] * n
        if len(even):
            some = texts.take(pa.array(even))
            rows = pc.replace_substring(pc.binary_join_element_wise(
                pa.scalar(START, pa.large_string()), some, pa.scalar("", pa.large_string())), "\n", " \n")
            ids, many = self._placed(rows)
            sizes[even] = many
            for k, part in zip(even.tolist(), np.split(ids, np.cumsum(many)[:-1]), strict=True):
                found[k] = part
        for k in np.flatnonzero((length > 0) & (whole | (length > 4 * SLICE))).tolist():
            text = texts[k].as_py()
            found[k] = np.array(self._ids(text), np.uint32) if whole[k] else self._long(text)
            sizes[k] = len(found[k])
        parts = [f for f in found if f is not None]
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32), sizes

    def slices(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """``batch`` of texts ``first`` to ``last``, of about SLICE bytes at a time."""
        total = np.append(0, np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)))
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(total, total[first] + SLICE, "right")) - 1)
            yield first, last, *self.batch(texts.slice(first, last - first))
            first = last


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    """The tokenizer of this process."""
    return WordTokens(path)


def frequencies(counts: np.ndarray, scale_bits: int) -> np.ndarray:
    """Counts (all positive) scaled to sum to ``1 << scale_bits``, none below 1."""
    whole = 1 << scale_bits
    freq = np.maximum(1, counts * (whole / counts.sum())).astype(np.int64)
    over = int(freq.sum()) - whole
    if over > 0:
        freq -= (freq - 1) * over // int((freq - 1).sum())
        over = int(freq.sum()) - whole
        big = np.argsort(-freq, kind="stable")[:over]  # the rest, one each
        freq[big] -= 1
    elif over < 0:
        freq[freq.argmax()] -= over
    return freq


def encode_segment(ids: np.ndarray) -> bytes:
    """One segment: header, table, block index and coded blocks."""
    counts = np.bincount(ids)  # as long as the vocabulary
    symbols = np.flatnonzero(counts)
    at, counts = np.cumsum(counts > 0)[ids] - 1, counts[symbols]
    bits = max(12, int(len(symbols)).bit_length() + 2)
    freq = frequencies(counts, bits)
    start = np.concatenate([[0], np.cumsum(freq)[:-1]])
    n_blocks = -(-len(ids) // BLOCK)
    steps = BLOCK // LANES if n_blocks > 1 else -(-len(ids) // LANES)
    padded = np.full(n_blocks * steps * LANES, counts.argmax(), np.int64)
    padded[:len(ids)] = at
    grid = padded.reshape(n_blocks, steps, LANES)
    f_of, s_of = freq.astype(np.uint64), start.astype(np.uint64)
    x = np.full((n_blocks, LANES), LOW, np.uint64)
    room, low32, shift = np.uint64((LOW >> bits) << 32), np.uint64(0xFFFFFFFF), np.uint64(bits)
    words, owners = [], []
    rows = np.broadcast_to(np.arange(n_blocks)[:, None], x.shape)
    for step in range(steps - 1, -1, -1):
        f = f_of[grid[:, step]]
        full = x >= room * f
        words.append((x[full] & low32).astype(np.uint32))
        owners.append(rows[full])
        x = np.where(full, x >> np.uint64(32), x)
        q = x // f
        x = (q << shift) + (x - q * f) + s_of[grid[:, step]]
    words, owners = np.concatenate(words[::-1]), np.concatenate(owners[::-1])
    words = words[np.argsort(owners, kind="stable")]  # by block, in the order of decoding
    sizes = np.bincount(owners, minlength=n_blocks).astype(np.uint32)
    raw = ids.astype("<u4")
    sums = np.array([zlib.crc32(raw[k * BLOCK:(k + 1) * BLOCK].tobytes()) for k in range(n_blocks)], np.uint32)
    table = zlib.compress(np.diff(symbols, prepend=0).astype("<u4").tobytes() + freq.astype("<u4").tobytes())
    head = struct.pack("<8sIIIIQ", MAGIC, len(symbols), bits, n_blocks, steps, len(ids))
    return b"".join([head, struct.pack("<I", len(table)), table, sizes.astype("<u4").tobytes(),
                     sums.astype("<u4").tobytes(), x.astype("<u8").tobytes(), words.astype("<u4").tobytes()])


def decode_segment(data: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids of the segment's blocks ``first`` to ``last`` (all); raises if a checksum differs."""
    magic, n_symbols, bits, n_blocks, steps, total = struct.unpack_from("<8sIIIIQ", data)
    if magic != MAGIC:
        raise ValueError("not a token segment")
    at = struct.calcsize("<8sIIIIQ")
    (size,) = struct.unpack_from("<I", data, at)
    table = np.frombuffer(zlib.decompress(data[at + 4:at + 4 + size]), "<u4").astype(np.int64)
    at += 4 + size
    symbols, freq = np.cumsum(table[:n_symbols]).astype(np.uint32), table[n_symbols:]
    sizes = np.frombuffer(data, "<u4", n_blocks, at)
    sums = np.frombuffer(data, "<u4", n_blocks, at + 4 * n_blocks)
    states = np.frombuffer(data, "<u8", n_blocks * LANES, at + 8 * n_blocks).reshape(n_blocks, LANES)
    words = np.frombuffer(data, "<u4", -1, at + 8 * n_blocks + 8 * n_blocks * LANES)
    last = n_blocks if last is None else last
    of_slot = np.repeat(np.arange(n_symbols), freq)
    f_of = freq.astype(np.uint64)
    s_of = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
    x = states[first:last].astype(np.uint64)
    begin = np.concatenate([[0], np.cumsum(sizes.astype(np.int64))])[first:last]
    out = np.empty((last - first, steps, LANES), np.int64)
    mask, shift = np.uint64((1 << bits) - 1), np.uint64(bits)
    words = np.append(words, np.uint32(0)).astype(np.uint64)  # one to look at past the end
    for step in range(steps):
        slot = x & mask
        s = of_slot[slot.astype(np.int64)]
        out[:, step] = s
        x = f_of[s] * (x >> shift) + slot - s_of[s]
        low = x < LOW
        order = np.cumsum(low, axis=1)
        take = np.where(low, begin[:, None] + order - 1, len(words) - 1)
        x = np.where(low, (x << np.uint64(32)) | words[take], x)
        begin = begin + order[:, -1]
    ids = symbols[out].reshape(last - first, -1)
    parts = []
    for k in range(first, last):
        part = ids[k - first][:min(BLOCK, total - k * BLOCK)]
        if zlib.crc32(part.astype("<u4").tobytes()) != int(sums[k]):
            raise ValueError(f"checksum of block {k} differs")
        parts.append(part)
    return np.concatenate(parts) if parts else np.empty(0, np.uint32)


CATALOGUE = ("part int, number int, file string, place bigint, size bigint, n_tokens bigint, "
             "docs array<struct<doc_id:bigint, n_tokens:bigint>>")
CATALOGUE_FOLDER = "catalogue"


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 2, segment: int = SEGMENT,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the ids of ``docs`` in ascending order of id; returns the catalogue, a row per segment.

    A document's ids lie in one segment, which may be longer than ``segment`` for a very long document.
    """
    ship_package(docs.sparkSession)
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    # a repeated id can be parted too: by the hash of its texts
    ordered = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part = word_tokens(tokenizer_path), TaskContext.get().partitionId()
        end = np.array([end_id], np.uint32)
        held, ids, sizes, size, number = [], [], [], 0, 0

        def flush():
            data = encode_segment(np.concatenate(held))
            name = files.attempt_name("tok", number)
            files.write_bytes(folder, name, data)
            docs_of = pa.StructArray.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64())],
                                                 ["doc_id", "n_tokens"])
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([name]),
                 pa.array([0], pa.int64()), pa.array([len(data)], pa.int64()), pa.array([size], pa.int64()),
                 pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), docs_of)],
                ["part", "number", "file", "place", "size", "n_tokens", "docs"])
        for batch in batches:
            names = batch.column(0).to_pylist()
            for first, last, found, many in tokens.slices(batch.column(1)):
                ends = np.cumsum(many)
                for doc_id, n, stop in zip(names[first:last], many.tolist(), ends.tolist(), strict=True):
                    if size and (size + n + 1 > segment or len(ids) >= SEGMENT_DOCS):
                        yield flush()
                        held, ids, sizes, size, number = [], [], [], 0, number + 1
                    held += [found[stop - n:stop], end]
                    ids.append(doc_id)
                    sizes.append(n + 1)
                    size += n + 1
        if size:
            yield flush()
    return written(ordered.mapInArrow(pack, CATALOGUE), f"{folder}/{CATALOGUE_FOLDER}")


def open_tokens(spark, folder: str) -> DataFrame:
    """The catalogue of token files that ``write_tokens`` left in a folder."""
    return spark.read.schema(CATALOGUE).parquet(f"{folder}/{CATALOGUE_FOLDER}")


def with_starts(catalogue: DataFrame) -> DataFrame:
    """The catalogue with ``before``: ids in all segments before, summed first by part."""
    parts = catalogue.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # one row per task
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("p"))
    slim = catalogue.select("part", "number", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("q"))
    return (catalogue.join(slim, ["part", "number"]).join(starts, "part")
            .withColumn("before", F.col("p") + F.col("q")).drop("p", "q"))


READ = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
_READ = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]


def read_tokens(catalogue: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """Per document of the catalogued segments, from the files: READ's columns and, if asked for, the ids."""
    ship_package(catalogue.sparkSession)
    schema = pa.schema(_READ + [("ids", pa.list_(pa.int64()))] * with_ids)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slim = batch.select(["file", "place", "size", "before"]).to_pylist()
            for k, row in enumerate(slim):
                with files.open_file(folder, row["file"]) as f:
                    f.seek(row["place"])
                    ids = decode_segment(f.read(row["size"])).astype("<u4")
                docs = batch.column("docs")[k].values
                lengths = docs.field("n_tokens").to_numpy(zero_copy_only=False)
                ends = np.cumsum(lengths)
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                columns = [docs.field("doc_id"), pa.array(row["before"] + ends - lengths), pa.array(lengths),
                           pa.array(crc, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()),
                                                            pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
    return catalogue.mapInArrow(unpack, READ + ", ids array<bigint>" * with_ids)


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op6_rans_tokens(spark, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    """Contract query: token files of all documents are written, then read back."""
    folder = shared_folder(spark, "tokens")
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    catalogue = write_tokens(docs, folder, tokenizer_path or default_tokenizer())
    return read_tokens(with_starts(catalogue), folder)
