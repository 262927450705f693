"""Token ids in files of independent zstandard frames, one for each document, with a seek table.

A file is in the Zstandard seekable format, which any zstandard reader can decompress:

    frame of document 0, frame of document 1, ...
    skippable frame (INDEX): bytes for each id (2 or 4), then the doc_ids, 8 bytes each
    skippable frame (SEEK): for each frame its size, its size when decompressed and the low
        32 bits of the XXH64 of its content; then the footer: number of frames, flags, FOOTER

All numbers are little-endian. Documents are encoded and compressed where they are read; only
their frames are shuffled into the order of the ids. A reader takes the tail of the file, then only the frames of
the documents that it wants, and checks each against its checksum. Tasks write through
pyarrow's file systems, under names that no other attempt uses, so a lost or repeated task
leaves at most files that the manifest doesn't name.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidefetch.llm.common import fresh_path, settle, ship_package
from tidefetch.llm.tokens import encoder

# Fixed values of the public format.
SEEK = 0x184D2A5E
INDEX = 0x184D2A5D
FOOTER = 0x8F92EAB1
CHECKSUMS = 0x80

#: Bytes of ids after which a task begins a new file.
FILE_BYTES = 64 << 20
#: Stands for a null doc_id in a file.
NO_ID = -(1 << 63)


class FrameWriter:
    """Writes one file."""

    def __init__(self, out, width: int):
        self.out, self.width = out, width
        self.ids: list[int] = []
        self.table: list[bytes] = []
        self.raw = 0

    def add(self, doc_id: int | None, frame: bytes, raw: int, checksum: int) -> None:
        """A frame, the size of its content and the low 32 bits of the content's XXH64."""
        self.out.write(frame)
        self.ids.append(NO_ID if doc_id is None else doc_id)
        self.table.append(struct.pack("<III", len(frame), raw, checksum))
        self.raw += raw

    def close(self) -> None:
        index = struct.pack("<I", self.width) + np.asarray(self.ids, "<i8").tobytes()
        self.out.write(struct.pack("<II", INDEX, len(index)) + index)
        seek = b"".join(self.table) + struct.pack("<IBI", len(self.table), CHECKSUMS, FOOTER)
        self.out.write(struct.pack("<II", SEEK, len(seek)) + seek)
        self.out.close()


class FrameReader:
    """Reads documents of one file: by number, in any order."""

    def __init__(self, file, size: int):
        self.file = file
        count, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != FOOTER or flags != CHECKSUMS:
            raise ValueError("no seek table at the end of the file")
        length = 12 * count + 9
        kind, stated = struct.unpack("<II", self._at(size - length - 8, 8))
        if kind != SEEK or stated != length:
            raise ValueError("the seek table is damaged")
        rows = np.frombuffer(self._at(size - length, 12 * count), "<u4").reshape(count, 3)
        self.sizes, self.raw, self.sums = (rows[:, i].astype(np.int64) for i in range(3))
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        index = self._at(int(self.starts[-1]) + 8, 4 + 8 * count)
        self.width = struct.unpack("<I", index[:4])[0]
        self.doc_ids = np.frombuffer(index, "<i8", offset=4)
        self.zstd = zstandard.ZstdDecompressor()

    def _at(self, start: int, length: int) -> bytes:
        self.file.seek(start)
        return self.file.read(length)

    def __len__(self) -> int:
        return len(self.sizes)

    def document(self, number: int, frame: bytes | None = None) -> np.ndarray:
        """The ids of a document; raises ValueError if its frame is not what was written."""
        if frame is None:
            frame = self._at(int(self.starts[number]), int(self.sizes[number]))
        try:
            data = self.zstd.decompress(frame, max_output_size=int(self.raw[number]))
        except zstandard.ZstdError as failure:
            raise ValueError(f"frame {number} is damaged: {failure}") from failure
        if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.sums[number]:
            raise ValueError(f"frame {number} fails its checksum")
        return np.frombuffer(data, f"<u{self.width}").astype("<u4")

    def frames(self, numbers: list[int], most: int = 8 << 20) -> Iterator[tuple[int, np.ndarray]]:
        """The documents of ascending ``numbers``; neighbours are read together, up to ``most`` bytes."""
        at = 0
        while at < len(numbers):
            end, first = at + 1, int(self.starts[numbers[at]])
            while (
                end < len(numbers)
                and numbers[end] == numbers[end - 1] + 1
                and self.starts[numbers[end] + 1] - first <= most
            ):
                end += 1
            block = self._at(first, int(self.starts[numbers[end - 1] + 1]) - first)
            for n in numbers[at:end]:
                yield n, self.document(n, block[self.starts[n] - first : self.starts[n + 1] - first])
            at = end


def _width(path: str, end_id: int) -> int:
    """Bytes for each id."""
    return 2 if max(encoder(path).tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4


def _frames(path: str, end_id: int):
    """The frame of each document, and a number that tells its rows apart."""

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, width = encoder(path).encode, _width(path, end_id)
        kind, end = f"<u{width}", np.asarray([end_id], "<u4").tobytes()
        zstd, part, number = zstandard.ZstdCompressor(level=1), TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                rows = batch.slice(at, 1000)
                texts = encode(rows.column(1).to_pylist())
                # Ids and end ids of all rows are narrowed in one go.
                lengths = [len(ids) // 4 + 1 for ids in texts]
                data = np.frombuffer(end.join([*texts, b""]), "<u4").astype(kind).tobytes()
                ends = (np.cumsum(lengths) * width).tolist()
                parts = [data[a:b] for a, b in zip([0, *ends], ends)]
                made, raw = list(map(zstd.compress, parts)), list(map(len, parts))
                sums = [xxhash.xxh64_intdigest(p) & 0xFFFFFFFF for p in parts]
                numbers = (part << 40) + number + np.arange(len(made))
                number += len(made)
                columns = [rows.column(0), pa.array(sums, pa.int64()), pa.array(numbers, pa.int64()), pa.array(made, pa.binary()), pa.array(raw, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "sum", "number", "frame", "raw"])

    return frames


def _write(folder: str, width: int, file_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pafs.FileSystem.from_uri(folder)
        part, attempt, number, writer = TaskContext.get().partitionId(), uuid.uuid4().hex, 0, None
        done: list[tuple] = []

        def finish() -> None:
            writer.close()
            done.append((part, number, name, len(writer.ids), writer.raw // width, min(writer.ids), max(writer.ids)))

        for batch in batches:
            for doc_id, checksum, _, frame, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if writer is None:
                    name = f"part-{part:06d}-{number:04d}-{attempt}.zst"
                    system.create_dir(root, recursive=True)
                    writer = FrameWriter(system.open_output_stream(f"{root}/{name}", compression=None), width)
                writer.add(doc_id, frame, raw, checksum)
                if writer.raw >= file_bytes:
                    finish()
                    writer, number = None, number + 1
        if writer is not None:
            finish()
        names = ["part", "number", "name", "n_docs", "n_ids", "first_id", "last_id"]
        kinds = [pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 4]
        columns = list(zip(*done)) or [[]] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return write


def _read(folder: str, wanted: frozenset[int] | None):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            at = batch.schema.get_field_index
            for name, base in zip(batch.column(at("name")).to_pylist(), batch.column(at("base")).to_pylist()):
                path = f"{root}/{name}"
                with system.open_input_file(path) as file:
                    reader = FrameReader(file, system.get_file_info(path).size)
                    starts = base + np.concatenate([[0], np.cumsum(reader.raw // reader.width)])
                    ids = reader.doc_ids.tolist()
                    numbers = [i for i, d in enumerate(ids) if wanted is None or d in wanted]
                    rows: list[tuple] = []
                    held = 0
                    for n, got in reader.frames(numbers):
                        rows.append((None if ids[n] == NO_ID else ids[n], int(starts[n]), len(got), got.tobytes()))
                        held += 4 * len(got)
                        if held > 8 << 20:
                            yield _records(rows)
                            rows, held = [], 0
                    yield _records(rows)

    return read


def _records(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    columns = list(zip(*rows)) or [[]] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "start", "n_tokens", "ids"]
    )


def write_token_files(
    docs: DataFrame, tokenizer: str, end_id: int = 1, folder: str | None = None, file_bytes: int = FILE_BYTES
) -> tuple[str, DataFrame]:
    """Writes the ids of ``docs`` in ascending doc_id order; the folder and the manifest of its files.

    Each row is a document, a null or empty text the end id alone. Rows with equal doc_ids stand
    next to each other in the order of their frames' checksums, null doc_ids before all others;
    one doc_id may span files and tasks. Texts are not shuffled: each is encoded and compressed
    where it is read, and the frames are put in order. In a file a null doc_id is -2^63, so a row
    with that id is read back as null. Other columns play no part. Empty tables give no files. The manifest has a row for each file:
    part, number, name, n_docs, n_ids, first_id, last_id and base, the ids in files before it.
    """
    spark = docs.sparkSession
    ship_package(spark)
    folder = folder or fresh_path(spark, "token-files")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # Written, as bounds of ranges are sampled, and encoding is what takes the time.
    frames = settle(
        rows.mapInArrow(_frames(tokenizer, end_id), "doc_id long, sum long, number long, frame binary, raw long"), "frames"
    )
    order = ("doc_id", "sum", "number")
    manifest = settle(
        frames.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(
            _write(folder, _width(tokenizer, end_id), file_bytes),
            "part int, number int, name string, n_docs long, n_ids long, first_id long, last_id long",
        ),
        "manifest",
    )
    # As many sums as there are range partitions; the files of a part are summed up in Spark.
    totals = manifest.groupBy("part").agg(F.sum("n_ids")).collect()
    bases, before = [], 0
    for part, n in sorted(map(tuple, totals)):
        bases.append((part, before))
        before += n
    parts = spark.createDataFrame(bases, "part int, part_base long")
    earlier = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    manifest = manifest.join(parts, "part").withColumn(
        "base", F.col("part_base") + F.coalesce(F.sum("n_ids").over(earlier), F.lit(0))
    )
    return folder, manifest.drop("part_base")


def read_token_files(folder: str, manifest: DataFrame, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids of all documents or of some.

    Rows are in the order of start. With ``doc_ids`` only files that may hold one are opened, and
    only their frames are read.
    """
    if doc_ids is not None:
        keys = [F.col("first_id").__le__(d) & F.col("last_id").__ge__(d) for d in doc_ids]
        condition = F.lit(False)
        for key in keys:
            condition = condition | key
        manifest = manifest.where(condition)
    wanted = None if doc_ids is None else frozenset(doc_ids)
    return (
        manifest.select("name", "base")
        .repartitionByRange(_tasks(manifest.sparkSession), "base")
        .sortWithinPartitions("base")
        .mapInArrow(_read(folder, wanted), "doc_id long, start long, n_tokens long, ids binary")
    )


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
