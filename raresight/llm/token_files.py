"""Token ids as flat unsigned integer files with 64-bit document offsets.

One range partition of ``doc_id`` is one pair of files in a folder that all machines share:
``part-K.ids`` holds the ids of its documents one after the other (16 bits where the vocabulary
allows, else 32), ``part-K.idx`` the document ids and then the offsets (one more than documents),
all little-endian 64-bit.  A manifest table has a row per pair; prefix sums of its counts give every
partition's base.  A file is written under another name and renamed when it is whole, so a task that
runs again replaces equal content.

Null text is an empty document (the end id alone); a null doc_id sorts first and reads back as
null; rows with equal doc_id stay separate documents, ordered by their text; an empty table gives
an empty manifest and no files; other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from raresight.llm import token_ids
from raresight.llm.common import byte_slices, id_column, id_numbers, shuffle_partitions, written
from raresight.session import scratch_path

MANIFEST = "part int, file string, id_bytes int, n_docs long, n_tokens long"


def write_token_files(docs: DataFrame, vocabulary: str, end_id: int, folder: str | None = None, id_bytes: int = 2,
                      partitions: int | None = None, added: bool = False) -> DataFrame:
    """Write the files; returns the manifest (part, file, id_bytes, n_docs, n_tokens, base).  ``added``: see ``token_ids``."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-files")
    partitions = partitions or shuffle_partitions(spark)
    kind = {2: "<u2", 4: "<u4"}[id_bytes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        part = TaskContext.get().partitionId()
        name, own = f"{root}/part-{part:06d}", f".{uuid.uuid4().hex}"
        numbers, counts, out = [], [], None
        for batch in byte_slices(batches, "text"):
            if out is None:
                store.create_dir(root, recursive=True)
                out = store.open_output_stream(f"{name}.ids{own}")
            ids, n = token_ids.encode_column(batch.column("text"), vocabulary, end_id, added)
            if len(ids) and int(ids.max()) >= 1 << (8 * id_bytes):
                raise ValueError(f"an id needs more than {id_bytes} bytes")
            out.write(ids.astype(kind).tobytes())
            numbers.append(id_numbers(batch.column("doc_id")))
            counts.append(n)
        if out is None:
            return
        out.close()
        count = np.concatenate(counts)
        with store.open_output_stream(f"{name}.idx{own}") as f:
            f.write(np.concatenate([*numbers, [0], np.cumsum(count)]).astype("<i8").tobytes())
        for kind_of in ("ids", "idx"):
            store.move(f"{name}.{kind_of}{own}", f"{name}.{kind_of}")
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "file": [f"{folder}/part-{part:06d}"], "id_bytes": pa.array([id_bytes], pa.int32()),
                                          "n_docs": [len(count)], "n_tokens": [int(count.sum())]})

    ordered = docs.select("doc_id", "text").repartitionByRange(partitions, "doc_id").sortWithinPartitions("doc_id", "text")
    manifest = written(ordered.mapInArrow(run, MANIFEST), "token-manifest")
    # one row per file: the running sum is over as many rows as there are partitions
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(ahead), F.lit(0)))


def mapped(store: fs.FileSystem, path: str, kind: str) -> np.ndarray:
    """A file as an array: memory-mapped where the file system is local, else read."""
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, kind, "r") if store.get_file_info(path).size else np.zeros(0, kind)
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read_buffer(), kind)


def read_token_files(manifest: DataFrame, with_ids: bool = True, rows: int = 1024) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of the ids as
    little-endian unsigned 32-bit integers, and the ids themselves if ``with_ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file in (r for b in batches for r in b.to_pylist()):
            store, root = fs.FileSystem.from_uri(file["file"])
            ids = mapped(store, f"{root}.ids", f"<u{file['id_bytes']}")
            index = mapped(store, f"{root}.idx", "<i8")
            n = file["n_docs"]
            numbers, offsets = index[:n], index[n:]
            for at in range(0, n, rows):
                bound = np.asarray(offsets[at: at + rows + 1])
                some = ids[bound[0]: bound[-1]].astype("<u4")
                edge = (bound - bound[0]).tolist()
                found = [some[a:b].tobytes() for a, b in zip(edge, edge[1:])]
                out = [id_column(np.asarray(numbers[at: at + rows])), pa.array(bound[:-1] + file["base"], pa.int64()), pa.array(np.diff(bound), pa.int64()),
                       pa.array([zlib.crc32(x) for x in found], pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(np.array(edge, np.int32)), pa.array(some.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return manifest.repartition(shuffle_partitions(manifest.sparkSession), "part").mapInArrow(run, schema)
