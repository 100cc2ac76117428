"""Token IDs as flat files of unsigned integers with 64-bit document offsets, to be memory-mapped.

A folder holds, for each partition of the documents in ascending order of id, part-N.ids (little-endian unsigned integers,
16 bits where the vocabulary allows, else 32), part-N.offsets (64-bit: where each document starts in the file, and the
end) and part-N.docs (64-bit document ids; NO_ID for null). The manifest has a row for each part with its number of
tokens and its base: the tokens of all parts before it, by a prefix sum over parts. A document's place among all tokens
is its part's base plus its offset.
"""

from __future__ import annotations

import functools
import json
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadsieve.llm.bpe import byte_letters, read_config
from leadsieve.llm.common import whole
from leadsieve.llm.pieces import Kept, chunks, latin, slices

#: Stands for a null document id.
NO_ID = -(1 << 63)
MANIFEST = "part long, n_docs long, n_tokens long, width int"


class Encoder:
    """Bytes of a text's IDs by the tokenizers library.

    by_word: the tokenizer drops white space and looks at words one by one, as its file says; then distinct pieces are
    encoded once each. Else whole texts are given to the library.
    """

    def __init__(self, config: str):
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        made = json.loads(config)
        self.library = Tokenizer.from_str(config)
        self.library.no_truncation()
        self.library.no_padding()
        size = max(self.library.get_vocab(with_added_tokens=True).values()) + 1
        self.dtype, self.code = (np.dtype("<u2"), "H") if size <= 1 << 16 else (np.dtype("<u4"), "I")
        self.by_word = drops_white_space(made)
        self.letters = {b: c for c, b in byte_letters().items()}
        self.of_chunk = Kept(self._chunk)

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isalpha() and latin(chunk):  # one word, which the library's model takes as it is
            shown = chunk.lower().encode().decode("latin-1").translate(self.letters)
            return array(self.code, [t.id for t in self.library.model.tokenize(shown)]).tobytes()
        return self._whole(chunk)

    def _whole(self, text: str) -> bytes:
        return array(self.code, self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        if not self.by_word:
            return self._whole(text)
        plain = "<|" not in text and latin(text)
        return b"".join(map(self.of_chunk.__getitem__, chunks(text.lower() if plain else text, lone_marks=plain)))


def drops_white_space(config: dict) -> bool:
    """Whether a tokenizer file lowers case, drops white space and cuts runs of letters, single digits and other marks."""
    kinds = [n["type"] for n in (config.get("normalizer") or {}).get("normalizers", [])]
    first = ((config.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    return kinds == ["NFC", "Replace", "Lowercase"] and first.get("behavior") == "Removed" and bool(first.get("invert"))


@functools.lru_cache(maxsize=2)
def encoder(config: str) -> Encoder:
    return Encoder(config)


def _store(folder: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(folder)


def _put(store, path: str, parts) -> None:
    """Write a file under a name of this attempt, then give it its name: a repeated task replaces it as a whole."""
    own = f"{path}.{TaskContext.get().taskAttemptId()}"
    with store.open_output_stream(own) as out:
        for part in parts:
            out.write(part)
    store.move(own, path)


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int | None = None, doc_id: str = "doc_id",
                      text: str = "text") -> DataFrame:
    """Write documents' IDs below folder (any store that pyarrow and Spark reach) and return the manifest.

    Documents come in ascending order of id, null ids first; rows with one id in order of a hash of their text. end_id
    follows each document. Null and empty texts have the end ID only. Columns besides the two are ignored. An empty table
    gives an empty manifest.
    """
    spark = docs.sparkSession
    config = spark.sparkContext.broadcast(read_config(path))  # one tokenizer file
    end = end_id
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text"),
                       F.xxhash64(whole(text)).alias("tie"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("doc_id").asc_nulls_first(), "tie", "row"]
    store, root = _store(folder)
    store.create_dir(root)

    def write(batches):
        import pyarrow as pa
        batch = next(batches, None)
        if batch is None:
            return
        tool = encoder(config.value)
        stop = b"" if end is None else array(tool.code, [end]).tobytes()
        own, base = _store(folder)
        part = TaskContext.get().partitionId()
        ids, offsets = array("q"), array("Q", [0])

        def encoded() -> Iterator[bytes]:
            at = 0
            for small in slices(_chain(batch, batches)):
                ids.extend(NO_ID if i is None else i for i in small.column(0).to_pylist())
                for t in small.column(1).to_pylist():
                    made = tool.encode(t) + stop
                    at += len(made) // tool.dtype.itemsize
                    offsets.append(at)
                    yield made

        stem = f"{base}/part-{part:06d}"
        _put(own, f"{stem}.ids", encoded())
        _put(own, f"{stem}.offsets", [offsets.tobytes()])
        _put(own, f"{stem}.docs", [ids.tobytes()])
        yield pa.RecordBatch.from_pydict({"part": [part], "n_docs": [len(ids)], "n_tokens": [offsets[-1]],
                                          "width": pa.array([tool.dtype.itemsize], pa.int32())})

    parts = (rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
             .mapInArrow(write, MANIFEST))
    parts.write.parquet(f"{folder}/parts")
    return manifest(spark, folder)


def _chain(first, rest):
    yield first
    yield from rest


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per part: part, n_docs, n_tokens, width, base. The prefix sum has a row per file, not per document."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return spark.read.schema(MANIFEST).parquet(f"{folder}/parts").withColumn(
        "base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


class Part:
    """One part's files: document ids, offsets, and IDs mapped into memory where the store is a file system."""

    def __init__(self, folder: str, part: int, width: int):
        store, root = _store(folder)
        stem, dtype = f"{root}/part-{part:06d}", np.dtype(f"<u{width}")

        def read(name: str, kind: str) -> np.ndarray:
            with store.open_input_file(f"{stem}.{name}") as f:
                return np.frombuffer(f.read(), dtype=kind)

        self.docs, self.offsets = read("docs", "<i8"), read("offsets", "<u8").astype(np.int64)
        if store.type_name != "local":
            self.ids = read("ids", dtype)
        else:  # an empty file can't be mapped
            self.ids = np.memmap(f"{stem}.ids", dtype, "r") if self.offsets[-1] else np.zeros(0, dtype)

    def __len__(self) -> int:
        return len(self.docs)

    def __getitem__(self, k: int) -> np.ndarray:
        return self.ids[self.offsets[k]:self.offsets[k + 1]]


ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_token_files(spark: SparkSession, folder: str, rows: int = 10_000) -> DataFrame:
    """What the files hold, per document: doc_id, start among all tokens, n_tokens, unsigned CRC-32 of the IDs as 32-bit
    integers. Each part is read by one task from its mapped files."""
    import pyarrow as pa
    parts = manifest(spark, folder)
    count = parts.count()  # of files

    def read(batches):
        for batch in batches:
            for one in batch.to_pylist():
                part = Part(folder, one["part"], one["width"])
                for at in range(0, len(part), rows):
                    here = range(at, min(at + rows, len(part)))
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array([None if part.docs[k] == NO_ID else int(part.docs[k]) for k in here], pa.int64()),
                        "start": pa.array(part.offsets[at:at + len(here)] + one["base"], pa.int64()),
                        "n_tokens": pa.array(np.diff(part.offsets[at:at + len(here) + 1]), pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(part[k].astype("<u4").tobytes()) for k in here], pa.int64())})

    return parts.select("part", "width", "base").repartitionByRange(max(1, count), "part").mapInArrow(read, ROWS)
