"""Byte-pair encoding and decoding with a published vocabulary file (operator 7).

Encoding keeps a document's symbols in a doubly linked list and the possible
merges in a priority queue of (merge rank, position).  Popping an entry whose
symbols have changed since it was pushed skips it (a stale entry); otherwise
the two symbols are joined and the pairs with the new neighbours are pushed.
Decoding concatenates vocabulary strings.

The file's own pipeline comes first: special strings are cut out of the raw
text, the rest is NFC-normalised and lower-cased, split by the file's pattern
and mapped to byte characters.  White space always separates, so a text is cut
at blanks and line ends and each piece is encoded on its own; pieces repeat,
and a bounded memo per Python worker remembers them (it changes no result).

Defined results: a null or empty text has no tokens and decodes to the empty
string; rows are independent, so repeated rows, null ids and empty tables
need no special case.  Texts are never cut or shortened.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varzea.llm.common import Memo, fresh

#: Distinct words, and pieces, that a worker remembers; no result depends on it.
MEMO_ENTRIES = 500_000
#: Longer pieces are encoded but not remembered.
MEMO_PIECE_CHARS = 64
POSITION_BITS = 40
POSITION_MASK = (1 << POSITION_BITS) - 1


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: printable Latin-1
    bytes are themselves, the others follow from code point 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = [], 256
    for b in range(256):
        if b in own:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


class Codec:
    """Encoder and decoder of one vocabulary file of the ``tokenizers`` format
    (BPE with an end-of-word suffix, lower case, white space dropped)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.string = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.special.items()}
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        self.rank = {(self.vocab[a], self.vocab[b]): r for r, (a, b) in enumerate(pairs)}
        self.joined = [self.vocab[a + b] for a, b in pairs]
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self._words = regex.compile(split).findall
        self._specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        chars = byte_characters()
        self._inner = [self.vocab[c] for c in chars]
        self._last = [self.vocab[c + self.suffix] for c in chars]
        self._word = Memo(self._encode_word, MEMO_ENTRIES, MEMO_PIECE_CHARS)
        self._piece = Memo(self._encode_piece, MEMO_ENTRIES, MEMO_PIECE_CHARS)

    def merge(self, ids: list[int]) -> list[int]:
        """Join symbols in the order of merge rank, leftmost first.

        A queue entry is rank and position in one integer; it is stale if the
        pair that now stands at its position has another rank or none."""
        rank_of, n = self.rank.get, len(ids)
        queue = [(r << POSITION_BITS) | i for i, pair in enumerate(zip(ids, ids[1:])) if (r := rank_of(pair)) is not None]
        if not queue:
            return ids
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heapq.heapify(queue)
        while queue:
            entry = heapq.heappop(queue)
            i = entry & POSITION_MASK
            j = after[i]
            if j >= n or ids[i] < 0 or rank_of((ids[i], ids[j])) != entry >> POSITION_BITS:
                continue  # stale
            new = ids[i] = self.joined[entry >> POSITION_BITS]
            ids[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank_of((new, ids[k]))) is not None:
                    heapq.heappush(queue, (r << POSITION_BITS) | i)
            h = before[i]
            if h >= 0 and (r := rank_of((ids[h], new))) is not None:
                heapq.heappush(queue, (r << POSITION_BITS) | h)
        return [x for x in ids if x >= 0]

    def _normal(self, text: str) -> str:
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:  # the file lower-cases character by character, without the final-sigma rule
            return "".join(c.lower() for c in text)
        return text.lower()

    def _encode_word(self, word: str) -> list[int]:
        raw = word.encode()
        ids = [self._inner[b] for b in raw[:-1]]
        ids.append(self._last[raw[-1]])
        return self.merge(ids)

    def _encode_piece(self, piece: str) -> tuple[bytes, str]:
        """Packed ids of a piece without blanks, and their strings joined as decode() joins."""
        ids: list[int] = []
        for part in self._specials.split(piece) if "<|" in piece else (piece,):
            if part in self.special:
                ids.append(self.special[part])
            else:
                for word in self._words(self._normal(part)):
                    ids += self._word[word]
        return pack(ids), self.decode(ids)

    def pieces(self, text: str | None) -> list[tuple[bytes, str]]:
        if not text:
            return []
        return [p for p in map(self._piece.__getitem__, text.replace("\n", " ").split(" ")) if p[0]]

    def encode(self, text: str | None) -> list[int]:
        """Token ids of a whole text."""
        packed = array("I")
        packed.frombytes(b"".join(p[0] for p in self.pieces(text)))
        return packed.tolist()

    def decode(self, ids: list[int]) -> str:
        """Vocabulary strings; the file names no decoder, so a blank joins them."""
        return " ".join(map(self.string.__getitem__, ids))


def pack(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    a = array("I", ids)
    if a.itemsize != 4:
        raise RuntimeError("unsigned int is not 32 bits here")
    return a.tobytes()


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


DIGEST = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                       T.StructField("decoded_sha256", T.StringType())])


def encode_column(path: str):
    """Pandas UDF text -> array of token ids."""
    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = codec(path)
        for texts in batches:
            yield pd.Series([c.encode(t) for t in texts], index=texts.index)
    return run


def decode_column(path: str):
    """Pandas UDF array of token ids -> decoded text (null is empty)."""
    @F.pandas_udf(T.StringType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = codec(path)
        for ids in batches:
            yield pd.Series(["" if x is None else c.decode(list(x)) for x in ids], index=ids.index)
    return run


def digest_column(path: str):
    """Pandas UDF text -> number of tokens, hash of the ids, hash of the decoded text."""
    @F.pandas_udf(DIGEST)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = codec(path)
        for texts in batches:
            rows = []
            for t in texts:
                parts = c.pieces(t)
                ids = b"".join([p[0] for p in parts])
                text = " ".join([p[1] for p in parts])
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
            yield pd.DataFrame(rows, columns=DIGEST.names)
    return run


def digests(docs: DataFrame, path: str) -> DataFrame:
    """One row per row of ``docs``: doc_id and the digests of its round trip."""
    d = fresh(docs, "digest")
    return (docs.withColumn(d, digest_column(path).asNondeterministic()(docs["text"]))
            .select("doc_id", f"{d}.*"))
