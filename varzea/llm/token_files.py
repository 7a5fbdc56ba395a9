"""Token-ID files (operator 12): every text encoded, its ids written Simple-8b
coded (``varzea.llm.simple8b``) in the order of the documents, and read back.

``write`` deals the documents by ranges of (doc_id, text), sorts each range and
encodes it; a task writes its range to one file, or to several of ``FILE_IDS``
ids.  It returns the manifest, one row per file.  A task writes under a name of
its own and only what it reports counts, so a file that a lost or repeated task
has left behind is in no manifest.  ``read`` gives the documents of a
manifest's files back, a block at a time.

A file, little-endian throughout:

    magic
    words         blocks of BLOCK_IDS ids (the last may be shorter), each a
                  Simple-8b stream of its own
    offsets       uint64, for each block and the end: words before it
    doc_id        int64, and a byte that is 1 where the id is null
    n_tokens      int64, ids of each document, the end id included
    trailer       uint64: ids a block, blocks, documents, ids; magic

A block is found through ``offsets`` and decoded alone, whatever documents it
holds parts of.

Text becomes ids through the ``tokenizers`` library and a published vocabulary
file.  White space always separates there, so a text is cut at blanks and line
ends and each distinct piece is encoded once and remembered (bounded; the memo
changes no result).  A piece of letters up to U+00FF and closing punctuation is
lower-cased here and goes to the library's model at once; all others go
through the library's whole pipeline.

Defined results: a null or empty text has the end id alone.  Null ids come
first.  Rows that share an id follow each other by the text's hash and the
text, each with its own start; equal rows are interchangeable.  Texts are never
cut.  A table without rows gives no files and no rows.

The folder must have a scheme that pyarrow's file systems know, or none.
"""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from varzea.llm import simple8b
from varzea.llm.bpe import byte_characters
from varzea.llm.common import Memo, partitions, ship_file, staged

END_ID = 2
BLOCK_IDS = 1 << 16
#: A file ends with the document that reaches this many ids.
FILE_IDS = 1 << 26
#: Distinct pieces that a worker remembers; no result depends on it.
MEMO_ENTRIES = 2_000_000
MAGIC = b"S8BTOK1\n"
_SIMPLE = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)").fullmatch

MANIFEST = "task int, seq int, file string, n_docs long, n_ids long"


class Encoder:
    """Ids of texts, packed as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.bytes = dict(enumerate(byte_characters()))
        self.memo = Memo(self._piece, MEMO_ENTRIES)

    def _word(self, word: str) -> list[int]:
        return [t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(self.bytes))]

    def _piece(self, piece: str) -> bytes:
        if m := _SIMPLE(piece):
            word, marks = m.groups()
            return pack(self._word(word.lower()) + (self._word(marks) if marks else []))
        return pack(self.library.encode(piece, add_special_tokens=False).ids)

    def __call__(self, text: str | None) -> bytes:
        return b"".join(map(self.memo.__getitem__, (text or "").replace("\n", " ").split(" ")))


def pack(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _open(path: str):
    """pyarrow file system of a path or URI, and the path in it."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(path) if re.match(r"\w[\w+.-]*:", path) else (fs.LocalFileSystem(), path)


class Writer:
    """One file; ids go to blocks as they come."""

    def __init__(self, path: str):
        system, at = _open(path)
        self.out = system.open_output_stream(at)
        self.out.write(MAGIC)
        self.waiting, self.n_waiting = [], 0
        self.offsets, self.docs, self.sizes, self.n_ids = array("Q", [0]), [], array("q"), 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // 4
        self.docs.append(doc_id)
        self.sizes.append(n)
        self.n_ids += n
        self.waiting.append(ids)
        self.n_waiting += n
        if self.n_waiting >= BLOCK_IDS:
            self._blocks(last=False)

    def _blocks(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.waiting), "<u4")
        whole = len(ids) if last else len(ids) - len(ids) % BLOCK_IDS
        for a in range(0, whole, BLOCK_IDS):
            words = simple8b.encode(ids[a:a + BLOCK_IDS])
            self.out.write(words.astype("<u8").tobytes())
            self.offsets.append(self.offsets[-1] + len(words))
        self.waiting, self.n_waiting = [ids[whole:].tobytes()], len(ids) - whole

    def close(self) -> None:
        self._blocks(last=True)
        self.out.write(np.array(self.offsets, "<u8").tobytes())
        self.out.write(np.array([0 if d is None else d for d in self.docs], "<i8").tobytes())
        self.out.write(np.array([d is None for d in self.docs], np.uint8).tobytes())
        self.out.write(np.array(self.sizes, "<i8").tobytes())
        self.out.write(np.array([BLOCK_IDS, len(self.offsets) - 1, len(self.docs), self.n_ids], "<u8").tobytes() + MAGIC)
        self.out.close()


def _write(folder: str, vocabulary: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        encode, end = encoder(SparkFiles.get(vocabulary)), pack([END_ID])
        task, name = TaskContext.get().partitionId(), uuid.uuid4().hex
        writer, made = None, []

        def close() -> None:
            writer.close()
            made.append((task, len(made), path, len(writer.docs), writer.n_ids))

        for batch in batches:
            for doc_id, text in zip(batch["id"].tolist(), batch["text"]):
                if writer is None:
                    path = f"{folder}/ids-{task:06d}-{len(made):04d}-{name}.s8b"
                    writer = Writer(path)
                writer.add(None if pd.isna(doc_id) else int(doc_id), encode(text) + end)
                if writer.n_ids >= FILE_IDS:
                    close()
                    writer = None
        if writer is not None:
            close()
        yield pd.DataFrame(made, columns=["task", "seq", "file", "n_docs", "n_ids"])
    return run


def write(docs: DataFrame, folder: str, vocabulary: str) -> DataFrame:
    """Write the ids of ``docs`` to files in the shared ``folder`` (which must
    be there); the manifest says where they are: task, seq (their order), file,
    n_docs, n_ids."""
    spark = docs.sparkSession
    name = ship_file(spark, vocabulary)
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(docs["doc_id"].cast("long").alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))
    dealt = rows.repartitionByRange(partitions(spark), "id", "h").sortWithinPartitions("id", "h", "text")
    # a null id as a float column would lose digits of the others
    whole = dealt.select(F.col("id").cast("string").alias("id"), "text")
    return staged(whole.mapInPandas(_write(folder, name), MANIFEST), "token-files")


class Reader:
    """One file."""

    def __init__(self, path: str):
        system, at = _open(path)
        self.file = system.open_input_file(at)
        size = self.file.size()
        tail = self._at(size - 32 - len(MAGIC), 32 + len(MAGIC))
        if tail[32:] != MAGIC or self._at(0, len(MAGIC)) != MAGIC:
            raise ValueError(f"not a whole token file: {path}")
        self.block_ids, blocks, docs, self.n_ids = np.frombuffer(tail[:32], "<u8").astype(np.int64).tolist()
        at = size - 32 - len(MAGIC) - 17 * docs - 8 * (blocks + 1)
        self.offsets = np.frombuffer(self._at(at, 8 * (blocks + 1)), "<u8").astype(np.int64)
        at += 8 * (blocks + 1)
        self.doc_id = np.frombuffer(self._at(at, 8 * docs), "<i8")
        self.null = np.frombuffer(self._at(at + 8 * docs, docs), np.uint8) != 0
        self.n_tokens = np.frombuffer(self._at(at + 9 * docs, 8 * docs), "<i8")

    def _at(self, place: int, size: int) -> bytes:
        return self.file.read_at(size, place)

    def block(self, k: int) -> np.ndarray:
        a, b = self.offsets[k:k + 2].tolist()
        words = np.frombuffer(self._at(len(MAGIC) + 8 * a, 8 * (b - a)), "<u8")
        return simple8b.decode(words, min(self.block_ids, self.n_ids - k * self.block_ids))

    def documents(self) -> Iterator[tuple[int | None, int, Iterator[np.ndarray]]]:
        """doc_id, n_tokens and the ids, in parts of one block at most."""
        k, ids = -1, np.empty(0, np.uint64)

        def parts(n: int) -> Iterator[np.ndarray]:
            nonlocal k, ids
            while n:
                if not len(ids):
                    k += 1
                    ids = self.block(k)
                part, ids = ids[:n], ids[n:]
                n -= len(part)
                yield part

        for doc_id, null, n in zip(self.doc_id.tolist(), self.null.tolist(), self.n_tokens.tolist()):
            yield None if null else doc_id, n, parts(n)


READ = "doc_id string, start long, n_tokens long, ids_crc32 long"


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, start in zip(batch["file"], batch["start"].tolist()):
            rows = []
            for doc_id, n, parts in Reader(path).documents():
                crc = 0
                for ids in parts:
                    crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                rows.append((None if doc_id is None else str(doc_id), start, n, crc))
                start += n
                if len(rows) == 100_000:
                    yield pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])
                    rows = []
            yield pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])


def read(manifest: DataFrame) -> DataFrame:
    """One row per document of the manifest's files: doc_id, start (ids before
    it), n_tokens, ids_crc32.  The starts of the files are summed up over the
    manifest, a row per file."""
    before = Window.orderBy("task", "seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"))
    rows = placed.repartition(2 * partitions(manifest.sparkSession), "file").mapInPandas(_read, READ)
    return rows.withColumn("doc_id", F.col("doc_id").cast("long"))
