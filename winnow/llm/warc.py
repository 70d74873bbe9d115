"""WARC archives: writing them, normalising whole-file gzip, reading by offset.

Archives arrive as one gzip stream over the whole file, where no record can be read
without inflating all before it.  The normaliser inflates such a stream once, writes
every record as a gzip member of its own and keeps a sidecar index of offsets.  After
that a record is one ranged read.

Files lie in the shared folder of the session and are opened through ``pyarrow.fs``,
which knows local, HDFS and object-store addresses.  A task writes under a name of its
attempt and moves the file when it is whole, so a repeated task leaves the same files.

Defined cases: a null html is the empty payload; payloads may hold any bytes; repeated
rows get a record each; an empty table gives no archive and an empty result; only the
named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.runtime import materialize, staging_path

CHUNK = 1 << 20
LEVEL = 3
ENTRIES = "file string, offset long, length long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, content string"


def record_bytes(page_id: int | None, url: str | None, payload: bytes) -> bytes:
    """One resource record with its headers."""
    sha1 = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    target = "".join(c for c in url or "" if c not in "\r\n")
    head = (
        "WARC/1.1\r\nWARC-Type: response\r\n"
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>\r\n"
        f"WARC-Target-URI: {target}\r\nWARC-Date: 1970-01-01T00:00:00Z\r\n"
        f"WARC-Payload-Digest: sha1:{sha1}\r\nContent-Type: text/html\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    )
    return head.encode("utf-8", "surrogatepass") + payload + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    return fields, rest[:int(fields["content-length"])]


def split_records(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """Cuts an inflated stream into records; holds one record and one chunk at a time."""
    held, need = bytearray(), 0
    for chunk in chunks:
        held += chunk
        while True:
            if not need:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                for line in bytes(held[:end]).split(b"\r\n"):
                    name, _, value = line.partition(b":")
                    if name.strip().lower() == b"content-length":
                        need = end + 4 + int(value) + 4
                if not need:
                    raise ValueError("record without Content-Length")
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = 0
    if held.strip():
        raise ValueError("the archive ends within a record")


def inflate(handle, chunk: int = CHUNK) -> Iterator[bytes]:
    """The content of a gzip file of one or more members, in chunks."""
    engine, fed = zlib.decompressobj(31), False
    while data := handle.read(chunk):
        while data:
            fed = True
            yield engine.decompress(data)
            data = engine.unused_data
            if engine.eof:
                engine, fed = zlib.decompressobj(31), False
    if fed:
        raise ValueError("the gzip stream is cut off")


def _open(base: str):
    from pyarrow import fs

    if "://" not in base and not base.startswith("file:"):
        return fs.LocalFileSystem(), base
    return fs.FileSystem.from_uri(base.replace("file:///", "/") if base.startswith("file:///") else base)


def _attempt() -> str:
    from pyspark import TaskContext

    context = TaskContext.get()
    return f"{context.partitionId()}-{context.taskAttemptId()}" if context else "driver"


def _write_monolithic(base: str, file_bytes: int, level: int):
    """Task: rows to whole-file gzip archives of about ``file_bytes`` of payload."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        files, root = _open(base)
        files.create_dir(root, recursive=True)
        part, names, out, engine, size = TaskContext.get().partitionId(), [], None, None, 0

        def close() -> None:
            out.write(engine.flush())
            out.close()
            files.move(names[-1][0], names[-1][1])

        for batch in batches:
            for page_id, url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if out is None:
                    name = f"{root}/part-{part:06d}-{len(names):04d}.warc.gz"
                    names.append((f"{name}.{_attempt()}", name))
                    out, engine, size = files.open_output_stream(names[-1][0], compression=None), zlib.compressobj(level, wbits=31), 0
                payload = (html.as_py() or "").encode("utf-8", "surrogatepass")
                out.write(engine.compress(record_bytes(page_id, url, payload)))
                size += len(payload)
                if size >= file_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([n for _, n in names], pa.string())], names=["file"])

    return run


def _normalise(base: str, level: int):
    """Task: whole-file gzip archives to archives of one member per record, with an index."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        files, root = _open(base)
        files.create_dir(root, recursive=True)
        for batch in batches:
            for source in batch.column(0).to_pylist():
                name = f"{root}/{source.rsplit('/', 1)[-1]}"
                rough, offset, entries = f"{name}.{_attempt()}", 0, []
                with files.open_input_stream(source, compression=None) as handle, \
                        files.open_output_stream(rough, compression=None) as out:
                    for record in split_records(inflate(handle)):
                        engine = zlib.compressobj(level, wbits=31)
                        member = engine.compress(record) + engine.flush()
                        out.write(member)
                        entries.append((offset, len(member)))
                        offset += len(member)
                with files.open_output_stream(f"{rough}.idx", compression=None) as out:
                    out.write("".join(f"{o} {n}\n" for o, n in entries).encode())
                files.move(rough, name)
                files.move(f"{rough}.idx", f"{name}.idx")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(entries), pa.string()), pa.array([o for o, _ in entries], pa.int64()),
                     pa.array([n for _, n in entries], pa.int64())], names=["file", "offset", "length"])

    return run


def _read(base: str):
    """Task: index entries to records; every entry is one ranged read."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        files, _ = _open(base)
        name, handle = None, None
        for batch in batches:
            rows = []
            for file, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if file != name:
                    if handle is not None:
                        handle.close()
                    name, handle = file, files.open_input_file(file)
                handle.seek(offset)
                fields, payload = parse_record(zlib.decompress(handle.read(length), wbits=31))
                page = fields["warc-record-id"][len("<urn:page:"):-1]
                digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                if fields["warc-payload-digest"] != f"sha1:{digest}":
                    raise ValueError(f"payload of record at {offset} in {file} does not match its digest")
                rows.append((int(page) if page else None, len(payload), digest, hashlib.sha256(payload).hexdigest()))
            columns = list(zip(*rows)) or [[]] * 4
            types = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            names = ["page_id", "payload_bytes", "payload_digest", "content"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
        if handle is not None:
            handle.close()

    return run


def write_monolithic(pages: DataFrame, base: str, file_bytes: int = 256 << 20, level: int = LEVEL) -> DataFrame:
    """Writes archives and returns their names."""
    rows = pages.select(F.col("page_id").cast("long"), "url", "html")
    return rows.mapInArrow(_write_monolithic(base, file_bytes, level), "file string")


def normalise(archives: DataFrame, base: str, level: int = LEVEL) -> DataFrame:
    """Rewrites archives record by record and returns the index entries.

    ``base/<name>.idx`` holds the same entries beside each file.  One archive is one
    task, since a gzip stream can only be inflated from its start.
    """
    spread = archives.repartition(archives.sparkSession.sparkContext.defaultParallelism, "file")
    return spread.mapInArrow(_normalise(base, level), ENTRIES)


def read_records(entries: DataFrame, base: str) -> DataFrame:
    return entries.mapInArrow(_read(base), RECORDS)


def revisits(records: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Marks repeated payloads of at least ``least_bytes`` as revisits of the largest page_id."""
    wanted = F.col("payload_bytes") >= least_bytes
    groups = materialize(
        records.where(wanted).groupBy("content", "payload_bytes")
        .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1")
        .select("content", "keeper"), "payloads")
    other = wanted & F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return records.join(groups, "content", "left").select(
        "page_id", "payload_bytes", "payload_digest",
        F.when(other, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(other, F.col("keeper")).alias("refers_to"))


def archive_pages(pages: DataFrame, least_bytes: int = 0, file_bytes: int = 256 << 20) -> DataFrame:
    """Archives all pages, normalises the archives and reads every record back."""
    base = staging_path(pages.sparkSession, "warc")
    archives = materialize(write_monolithic(pages, f"{base}/whole", file_bytes), "archives")
    entries = materialize(normalise(archives, f"{base}/records"), "entries")
    records = materialize(read_records(entries, base), "records")
    return revisits(records, least_bytes)
