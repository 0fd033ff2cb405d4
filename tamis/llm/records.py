"""Token ids as length-delimited binary records with a separate offset index.

A record is ``length (u64) | masked checksum of the length | payload | masked checksum of
the payload``, little-endian. The payload is ``has_key (u8), key (i64), width (u8), ids``
with ids of two bytes where the vocabulary allows, else four. An index file holds
``key (i64), offset (u64), length (u64)`` per record, for reads in any order.

Documents are sorted by key over range partitions; every task writes its files through the
file system that the shared folder names and reports them in a manifest. Only files of the
manifest are read, so attempts that were lost or ran twice leave no trace in the result.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import types
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamis.sources.staging import owned_folder, stage_table

END_ID = 2
FILE_BYTES = 64 << 20
CACHED_WORDS = 1 << 20
#: Characters of the texts whose words are looked up together.
PORTION_CHARS = 1 << 22
#: Where a tokenizer's pattern has this alternative, and none before it that begins with a letter,
#: a run of letters alone is one word.
LETTERS = r"[\p{L}]+"

# Fixed values of the record format's checksum mask.
MASK_DELTA = 0xA282EAD8

#: Hadoop's names of stores that pyarrow calls otherwise.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss"}

LENGTH, SUM, HEAD, ENTRY = "<Q", "<I", "<BqB", "<qQQ"
MANIFEST = "part int, seq int, path string, index string, n_records long, n_tokens long, bytes long"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack(LENGTH, len(payload))
    return b"".join((length, struct.pack(SUM, masked(length)), payload, struct.pack(SUM, masked(payload))))


def unframe(data: bytes) -> bytes:
    """The payload of one framed record; raises ValueError when a checksum does not hold."""
    length = data[:8]
    payload = data[12:-4]
    if struct.unpack(SUM, data[8:12])[0] != masked(length) or struct.unpack(LENGTH, length)[0] != len(payload):
        raise ValueError("a record's length is damaged")
    if struct.unpack(SUM, data[-4:])[0] != masked(payload):
        raise ValueError("a record's payload is damaged")
    return payload


def file_system(uri: str):
    """The file system of ``uri``, which has a scheme, and the path in it.

    Schemes by which Hadoop calls stores that pyarrow knows by another name are translated; one
    that pyarrow cannot serve is an error. Called at the driver before work starts.
    """
    from pyarrow import fs

    scheme, _, rest = uri.partition(":")
    if not rest:
        raise ValueError(f"a path with the scheme of its file system is needed: {uri}")
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{rest}")


class _Memo(dict):
    """Remembers what ``make`` gives for up to ``limit`` keys.

    Held are the last keys, and of those before the ones asked for again: when half are new, the
    older half goes, so rare keys, however many, do not drive out the frequent ones.
    """

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.half, self.older = make, max(1, limit // 2), {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.half:
            self.older = {}
            self.older.update(self)
            self.clear()
        self[key] = value
        return value


class Encoder:
    """Whole texts to ids, as the tokenizer gives them.

    Where the tokenizer lower-cases, splits into words and encodes each word on its own, the
    ids of a word, and of a run of words without white space, are kept for their next
    occurrence. That path takes texts of Latin letters and printable ASCII without markers
    of special tokens; all others go to the tokenizer whole.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind, self.code = f"<u{self.width}", "H" if self.width == 2 else "I"
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        split = (spec["pre_tokenizer"].get("pretokenizers") or [{}])[0]
        steps = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        self.split = None
        if split.get("invert") and split.get("behavior") == "Removed" and steps == ["NFC", "Replace", "Lowercase"]:
            self.split = regex.compile(split["pattern"]["Regex"]).findall
            self.plain = re.compile(r"[\t\n\r\x20-\x7E\xA1-\xAC\xAE-ɏ]*").fullmatch
            self.as_bytes = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
            self.words = _Memo(self._word, CACHED_WORDS)
            before, found, _ = f'|{split["pattern"]["Regex"]}|'.partition(f"|{LETTERS}|")
            self.one_word = bool(found) and all(x.startswith("'") for x in before.split("|")[1:])
            self.runs = _Memo(self._run, CACHED_WORDS // 2)
            pattern = in_plain_letters(split["pattern"]["Regex"])
            self.cut = (regex if r"\p" in pattern else re).compile(rf"\n|{pattern}").findall

    def _word(self, word: str) -> bytes:
        if word == "\n":  # between runs that are cut together
            return b""
        coded = word if word.isascii() else self.as_bytes(word)[0][0]
        return struct.pack(f"<{len(ids)}{self.code}", *ids) if (ids := [t.id for t in self.model.tokenize(coded)]) else b""

    def _run(self, run: str) -> bytes:
        if self.one_word and run.isalpha():
            return self.words[run]
        return b"".join(map(self.words.__getitem__, self.split(run)))

    def encode(self, text: str) -> bytes:
        if self.split is None or "<|" in text or not self.plain(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()
        return b"".join(map(self.runs.__getitem__, text.lower().split()))

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """What ``encode`` gives for each of ``texts``, in order; null is empty.

        A portion's texts are split together, and each distinct run is cut and looked up once.
        """
        held, size = [], 0
        for text in texts:
            held.append(text.as_py() or "")
            size += len(held[-1])
            if size >= PORTION_CHARS:
                yield from self._together(held)
                held, size = [], 0
        yield from self._together(held)

    def _together(self, texts: list[str]) -> Iterator[bytes]:
        plain = [self.split is not None and "<|" not in t and self.plain(t) is not None for t in texts]
        if not any(plain):
            yield from map(self.encode, texts)
            return
        lowered = pa.array([t.lower() if p else "" for t, p in zip(texts, plain, strict=True)], pa.large_string())
        runs = pc.ascii_split_whitespace(lowered)  # plain texts have no other white space
        known = runs.values.dictionary_encode()
        ids = self._ids_of(known.dictionary.to_numpy(zero_copy_only=False).tolist()).take(known.indices)
        _, ends, data = ids.buffers()
        cuts = np.frombuffer(ends, np.int64, len(ids) + 1)[runs.offsets.to_numpy()].tolist()
        for i, (text, p) in enumerate(zip(texts, plain, strict=True)):
            yield (data[cuts[i] : cuts[i + 1]].to_pybytes() if data else b"") if p else self.encode(text)

    def _ids_of(self, runs: list[str]) -> pa.LargeBinaryArray:
        """The ids of each run; all are cut into words at once, line by line."""
        words = self.cut("\n".join([*runs, ""]))
        ids = pa.array(list(map(self.words.__getitem__, words)), pa.large_binary())
        lines = np.flatnonzero(pc.equal(pa.array(words, pa.large_string()), "\n").to_numpy(zero_copy_only=False))
        ends = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1)[1:][lines]  # a line break has no ids
        offsets = pa.py_buffer(np.concatenate(([0], ends)))
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(runs), [None, offsets, ids.buffers()[2] or pa.py_buffer(b"")])


def in_plain_letters(pattern: str) -> str:
    """``pattern`` with the classes of letters and numbers as the lower-cased plain characters in them."""
    known = sorted({c for k in range(0x250) for c in chr(k).lower()})
    letters, numbers = "".join(filter(str.isalpha, known)), "".join(filter(str.isnumeric, known))
    return pattern.replace(r"\p{L}", letters).replace(r"\p{N}", numbers)


def kept(name: str, make):
    """What ``make`` gives, once per Python worker: workers are used for task after task."""
    worker = sys.modules.setdefault("tamis_llm_worker", types.ModuleType("tamis_llm_worker"))
    if not hasattr(worker, name):
        setattr(worker, name, make())
    return getattr(worker, name)


def _writer(tokenizer: str, folder: str, key: str, text: str, end_id: int, file_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = file_system(folder)
        encoder = kept(f"encoder {tokenizer}", lambda: Encoder(tokenizer))
        task = TaskContext.get()
        end = np.array([end_id], encoder.kind).tobytes()
        part, seq, body, index, done = task.partitionId(), 0, None, [], []
        size = tokens = 0

        def close() -> None:
            nonlocal body, index, seq, size, tokens
            if body is None:
                return
            body.close()
            with store.open_output_stream(f"{base}/{name}.index") as out:
                out.write(b"".join(index))
            done.append((part, seq, f"{folder}/{name}.records", f"{folder}/{name}.index", len(index), tokens, size))
            body, index, seq, size, tokens = None, [], seq + 1, 0, 0

        for batch in batches:
            for k, ids in zip(batch[key].to_pylist(), encoder.encode_all(batch[text]), strict=True):
                ids += end
                data = frame(struct.pack(HEAD, k is not None, k or 0, encoder.width) + ids)
                if body is None:
                    name = f"part-{part:06d}-{seq:05d}-{uuid.uuid4().hex}"
                    body = store.open_output_stream(f"{base}/{name}.records", buffer_size=1 << 20)
                body.write(data)
                index.append(struct.pack(ENTRY, k or 0, size, len(data)))
                size, tokens = size + len(data), tokens + len(ids) // encoder.width
                if size >= file_bytes:
                    close()
        close()
        if done:
            names = [x.split()[0] for x in MANIFEST.split(", ")]
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*done, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return write


def write_records(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Encode every whole text, write it as a record and return the stored manifest.

    Records are in ascending order of ``key`` (null first), equal keys by a hash of the text.
    A null text is empty; every record ends with ``end_id``. No documents give no files.
    Other columns are ignored. Files are cut at about ``file_bytes``.
    """
    spark = docs.sparkSession
    folder = owned_folder(spark, "records")
    store, base = file_system(folder)
    store.create_dir(base, recursive=True)
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("tie"))
    rows = rows.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie").select("key", "text")
    return stage_table(rows.mapInArrow(_writer(tokenizer, folder, "key", "text", end_id, file_bytes), MANIFEST), "manifest")


def _ids(payload: bytes) -> tuple[int | None, np.ndarray]:
    has, key, width = struct.unpack_from(HEAD, payload)
    return key if has else None, np.frombuffer(payload, f"<u{width}", offset=struct.calcsize(HEAD))


READ = "key long, start long, n_tokens long, ids_crc32 long"


def _read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            store, path = file_system(row["path"])
            start, out = row["start"], []
            with store.open_input_stream(path, buffer_size=1 << 20) as file:
                while head := file.read(12):
                    payload = unframe(head + file.read(struct.unpack(LENGTH, head[:8])[0] + 4))
                    key, ids = _ids(payload)
                    out.append((key, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
            names, columns = ["key", "start", "n_tokens", "ids_crc32"], zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def _dealt(files: DataFrame) -> DataFrame:
    """Few rows that each stand for a file, spread over tasks."""
    return files.repartition(max(1, min(files.count(), 4 * files.sparkSession.sparkContext.defaultParallelism)))


def read_records(manifest: DataFrame) -> DataFrame:
    """``(key, start, n_tokens, ids_crc32)`` of every record, read back in file order.

    ``start`` counts the ids of all records before; it is a prefix sum over one row per
    partition, then per file, then within the file.
    """
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    files = files.join(parts, "part").select("path", (F.col("base") + F.col("inside")).alias("start"))
    return _dealt(files).mapInArrow(_read_files, READ)


def read_index(manifest: DataFrame) -> DataFrame:
    """``(path, key, offset, length)`` of every record, from the index files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = file_system(row["index"])
                with store.open_input_stream(path) as file:
                    entries = list(struct.iter_unpack(ENTRY, file.read()))
                columns = [pa.array(c, pa.int64()) for c in zip(*entries, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["path"]] * len(entries)), *columns], names=["path", "key", "offset", "length"]
                )

    return _dealt(manifest.select("path", "index")).mapInArrow(read, "path string, key long, offset long, length long")


def fetch(entries: DataFrame) -> DataFrame:
    """``(key, ids)`` of index entries ``(path, offset, length)`` in whatever order they come."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, files, out = batch.to_pylist(), {}, []
            for row in rows:
                if row["path"] not in files:
                    store, path = file_system(row["path"])
                    files[row["path"]] = store.open_input_file(path)
                file = files[row["path"]]
                file.seek(row["offset"])
                key, ids = _ids(unframe(file.read(row["length"])))
                out.append((key, ids.astype(np.int64).tolist()))
            for file in files.values():
                file.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in out], pa.int64()), pa.array([i for _, i in out], pa.list_(pa.int64()))],
                names=["key", "ids"],
            )

    return entries.select("path", "offset", "length").mapInArrow(read, "key long, ids array<long>")
