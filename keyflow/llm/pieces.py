"""SentencePiece encoding by backtracking, and decoding.

The encoder gives the ids that merging would give, without merging the text. In
a run of merges no neighbouring tokens interact unless the pair alone would, so
a token sequence is the encoding exactly if re-merging each adjacent pair leaves
that pair. The search takes the longest match at each position (one Aho-Corasick
pass finds all matches), falls back to ever shorter prefixes, steps back when
none fits, and marks positions that failed. A prefix of the text has one valid
encoding, so a mark never depends on the way there.

Texts are cut where no piece can reach across: before a run of the blank mark
and around characters that occur in no piece. The units repeat, so their ids are
kept in a bounded table for each worker process.

Defined results: null text counts as empty and has no tokens; repeated rows each
get a row; an empty table gives none. Only models of merge type (BPE) with byte
fallback and without user-defined pieces are taken; others raise ValueError.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import ahocorasick
import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.llm.common import load_table, ship_package, text_of

BLANK = "▁"
MEMO = 500_000      # units, and as many pairs, that a worker keeps; a full table starts anew
LONG_UNIT = 64      # longer units are not kept


class _Memo(dict):
    """Bounded table of what ``make`` gives for a key."""

    def __init__(self, make, size: int = MEMO):
        super().__init__()
        self.make, self.limit = make, size

    def __missing__(self, key):
        value = self.make(key)
        if type(key) is int or len(key) <= LONG_UNIT:
            if len(self) >= self.limit:
                self.clear()
            self[key] = value
        return value


class PieceCodec:
    """Encoder and decoder of one model file."""

    def __init__(self, model_path: str):
        sp = self.sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        n = sp.get_piece_size()
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(sp.is_byte(i) for i in self.bytes):
            raise ValueError("the model has no byte fallback")
        self.score = {sp.id_to_piece(i): sp.get_score(i) for i in plain}
        self.names = {p: i for p, i in zip(self.score, plain, strict=True)}
        letters = set(chain.from_iterable(self.score))
        for extra, c in enumerate(sorted(letters - self.names.keys())):
            self.names[c] = n + extra  # an atom of pieces, itself none: bytes in the end
        self.pieces = n
        tokens = {p: i for p, i in self.names.items() if self._merge(p) == [p]}
        self.text = {i: p for p, i in tokens.items()}
        self.size = {i: len(p) for i, p in self.text.items()}
        self.shorter = {i: next((tokens[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in tokens), None)
                        for p, i in tokens.items()}
        self.find = ahocorasick.Automaton()
        for p, i in tokens.items():
            self.find.add_word(p, (i, len(p) - 1))
        self.find.make_automaton()
        self.letters = letters
        self.shift = max(self.names.values()).bit_length()
        self.digits = [str(i) for i in range(n)]
        inside = "".join(map(re.escape, sorted(letters)))
        self.known = re.compile(f"([{inside}]+)|([^{inside}]+)")
        apart = all(BLANK not in p.lstrip(BLANK) for p in self.score)
        self.cut = re.compile(f"{BLANK}+[^{BLANK}\n]*|[^{BLANK}\n]+|\n") if apart and "\n" not in letters else None
        self.fits = _Memo(self._fits)
        self.plain = _Memo(self._unit)
        self.spaced = _Memo(lambda u: self._unit(BLANK + u))

    def _merge(self, text: str) -> list[str]:
        """Merging as the library does it: the best pair first, of equal ones the leftmost."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fits(self, pair: int) -> bool:
        a, b = self.text[pair >> self.shift], self.text[pair & (1 << self.shift) - 1]
        return self._merge(a + b) == [a, b]

    def _search(self, text: str) -> list[int]:
        """Tokens of a text whose characters all occur in pieces."""
        n = len(text)
        longest = [0] * n
        for end, (i, less) in self.find.iter(text):
            longest[end - less] = i  # ends ascend, so the longest stays
        size, fits, shorter, shift = self.size, self.fits, self.shorter, self.shift
        failed, out, at, token, last = bytearray(n + 1), [], 0, longest[0], -1
        while at < n:
            end = at + size[token]
            if not failed[end] and (last < 0 or fits[last << shift | token]):
                out.append(token)
                at, last = end, token
                if at < n:
                    token = longest[at]
                continue
            less = shorter[token]
            if less is not None:
                token = less
            else:
                failed[at] = 1
                token = out.pop()  # its end has failed now, so a shorter one is next
                at -= size[token]
                last = out[-1] if out else -1
        return out

    def _unit(self, unit: str) -> bytes:
        if self.letters.issuperset(unit):
            ids = self._search(unit)
        else:
            ids = []
            for known, other in re.findall(self.known, unit):
                ids += self._search(known) if known else [self.bytes[b] for b in other.encode()]
        if ids and max(ids) >= self.pieces:
            ids = chain.from_iterable([i] if i < self.pieces else [self.bytes[b] for b in self.text[i].encode()]
                                      for i in ids)
        return array("I", ids).tobytes()

    def packed(self, text: str) -> bytes:
        """The ids of a text as unsigned 32-bit numbers."""
        norm = self.sp.normalize(text)
        if not norm:
            return b""
        if self.cut is None:
            return self._unit(norm)
        if BLANK + BLANK in norm:
            return b"".join([self.plain[u] for u in self.cut.findall(norm)])
        out: list[bytes] = []
        plain, spaced = self.plain, self.spaced.__getitem__
        for k, line in enumerate(norm.split("\n")):
            if k:
                out.append(plain["\n"])
            first, *rest = line.split(BLANK)
            if first:
                out.append(plain[first])
            out.extend(map(spaced, rest))
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return array("I", self.packed(text)).tolist()

    def decode(self, ids: list[int]) -> str:
        return self.sp.decode(ids)


@lru_cache(maxsize=2)
def codec(model_path: str) -> PieceCodec:
    """The codec of this process."""
    return PieceCodec(model_path)


def _row(c: PieceCodec, text: str) -> tuple:
    packed = c.packed(text)
    ids = array("I", packed).tolist()
    digits = ",".join(map(c.digits.__getitem__, ids))
    back = c.decode(ids) if ids else ""
    return len(ids), sha256(digits.encode()).hexdigest(), sha256(back.encode()).hexdigest(), np.frombuffer(packed, np.int32)


def encoded(docs: DataFrame, model_path: str, text_col: str = "text", into: str = "pieces",
            with_ids: bool = True) -> DataFrame:
    """``docs`` with a struct ``into``: n_tokens, ids_sha256, decoded_sha256 and, if asked for, the ids."""
    ship_package(docs.sparkSession)
    kind = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    names = [x.split()[0] for x in kind.split(", ")]

    @F.pandas_udf(kind)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = codec(model_path)
        for texts in batches:
            yield pd.DataFrame([_row(c, t)[:len(names)] for t in texts], columns=names)
    return docs.withColumn(into, of(text_of(text_col)))


def decoded(rows: DataFrame, model_path: str, ids_col: str = "ids", into: str = "text") -> DataFrame:
    """``rows`` with the text of a column of id arrays (null: null)."""
    ship_package(rows.sparkSession)

    @F.pandas_udf("string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = codec(model_path)
        for ids in batches:
            yield pd.Series([None if x is None else c.decode([int(i) for i in x]) for x in ids], dtype=object)
    return rows.withColumn(into, of(F.col(ids_col)))


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op2_sentencepiece(spark, sf_dir: str, model_path: str | None = None) -> DataFrame:
    """Contract query: doc_id, n_tokens, ids_sha256, decoded_sha256 over all documents."""
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    return encoded(docs, model_path or default_model(), into="__p", with_ids=False).select("doc_id", "__p.*")
