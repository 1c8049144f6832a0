"""Files of token ids with constant-time access by document key.

A file holds the ids of a range of documents one after the other, two bytes each where
the vocabulary allows it, and an index: a minimal perfect hash sends each key to a slot
of its own, which stores a fingerprint of the key and where its ids lie. A key that is
not in the file meets a wrong fingerprint and is told apart without storing the keys.

    header    64 bytes: magic, version, id width, documents, ids, buckets, salt
    ids       unsigned little-endian integers of the given width
    buckets   int32 each: a seed, or the slot itself as -1 - slot
    slots     fingerprint uint32, start and length uint64 each
    keys      doc_id int64, repeat uint32, null flag uint8, in file order
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaykit.llm.shared import stored

MAGIC, VERSION = b"IDSHARD\0", 1
HEADER = struct.Struct("<8sIIQQQQ16x")
SLOT = np.dtype([("print", "<u4"), ("start", "<u8"), ("length", "<u8")])
KEY = np.dtype([("doc_id", "<i8"), ("repeat", "<u4"), ("null", "u1")])
PER_BUCKET = 4
SEEDS = 64
JOINED = 32
MANIFEST = "part int, file int, path string, first_id long, last_id long, n_docs long, n_ids long"


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads near ones apart."""
    x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(keys: np.ndarray, salt: int) -> np.ndarray:
    once = _mix(keys["doc_id"].astype(np.int64).view(np.uint64) ^ np.uint64(salt))
    tail = keys["repeat"].astype(np.uint64) << np.uint64(1) | keys["null"].astype(np.uint64)
    return _mix(once ^ tail)


def _slots(hashes: np.ndarray, seeds: np.ndarray, size: int) -> np.ndarray:
    return (_mix(hashes ^ _mix(seeds.astype(np.uint64))) % np.uint64(size)).astype(np.int64)


def build_hash(keys: np.ndarray) -> tuple[int, np.ndarray]:
    """A salt and a number per bucket that send distinct keys to the slots 0 to n - 1.

    Large buckets come first and try seeds until their keys meet free slots; a bucket of
    one key takes any free slot. A salt under which two hashes agree, or a bucket finds no
    seed, is given up for the next.
    """
    n = len(keys)
    n_buckets = max(1, -(-n // PER_BUCKET))
    for salt in range(1, 100):
        hashes = _hashes(keys, salt)
        if len(np.unique(hashes)) < n:
            continue
        bucket = (hashes % np.uint64(n_buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=n_buckets)
        starts = np.cumsum(sizes) - sizes
        found = np.zeros(n_buckets, dtype="<i4")
        taken = np.zeros(n, dtype=bool)
        by_size = np.argsort(-sizes, kind="stable")
        for b in by_size[sizes[by_size] > 1]:
            own = hashes[order[starts[b] : starts[b] + sizes[b]]]
            for first in range(0, 1 << 20, SEEDS):
                seeds = np.arange(first, first + SEEDS)
                slots = np.sort(_slots(own[None, :], seeds[:, None], n), axis=1)
                good = ~taken[slots].any(axis=1) & (np.diff(slots, axis=1) > 0).all(axis=1)
                if good.any():
                    at = int(good.argmax())
                    found[b] = first + at
                    taken[slots[at]] = True
                    break
            else:
                break
        else:
            free = np.flatnonzero(~taken)
            ones = by_size[sizes[by_size] == 1]
            found[ones] = -1 - free[: len(ones)]
            return salt, found
    raise ValueError("keys are repeated")


def _found(hashes: np.ndarray, seeds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    slots = np.where(seeds < 0, -1 - seeds, _slots(hashes, np.maximum(seeds, 0), n))
    return slots, (_mix(~hashes) >> np.uint64(32)).astype(np.uint32)


def find_slots(keys: np.ndarray, n: int, salt: int, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slot and fingerprint of each key, by a table read each, whatever the file's size."""
    hashes = _hashes(keys, salt)
    return _found(hashes, buckets[(hashes % np.uint64(len(buckets))).astype(np.int64)].astype(np.int64), n)


class IdFile:
    """A whole file in memory."""

    def __init__(self, data: bytes):
        magic, version, width, n, n_ids, n_buckets, self.salt = HEADER.unpack_from(data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a file of token ids")
        at = HEADER.size
        self.payload = np.frombuffer(data, f"<u{width}", n_ids, at)
        at += n_ids * width
        self.buckets = np.frombuffer(data, "<i4", n_buckets, at)
        at += n_buckets * 4
        self.slots = np.frombuffer(data, SLOT, n, at)
        self.keys = np.frombuffer(data, KEY, n, at + n * SLOT.itemsize)

    def spans(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each key is here, and its start and length."""
        if not len(self.slots):
            nothing = np.zeros(len(keys), dtype=np.int64)
            return nothing.astype(bool), nothing, nothing
        at, prints = find_slots(keys, len(self.slots), self.salt, self.buckets)
        slot = self.slots[at]
        return slot["print"] == prints, slot["start"].astype(np.int64), slot["length"].astype(np.int64)


def read_ids(f, doc_id: int | None, repeat: int = 0) -> np.ndarray | None:
    """A document's ids from an open file, by four short reads; None if it isn't there."""
    magic, version, width, n, n_ids, n_buckets, salt = HEADER.unpack(f.read_at(HEADER.size, 0))
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a file of token ids")
    if not n:
        return None
    key = np.array([(doc_id or 0, repeat, doc_id is None)], dtype=KEY)
    at = HEADER.size + n_ids * width
    bucket = int(_hashes(key, salt)[0] % np.uint64(n_buckets))
    seed = np.frombuffer(f.read_at(4, at + 4 * bucket), "<i4")
    slots, prints = _found(_hashes(key, salt), seed.astype(np.int64), n)
    at += 4 * n_buckets + SLOT.itemsize * int(slots[0])
    slot = np.frombuffer(f.read_at(SLOT.itemsize, at), SLOT)[0]
    if slot["print"] != prints[0]:
        return None
    start, length = int(slot["start"]), int(slot["length"])
    return np.frombuffer(f.read_at(length * width, HEADER.size + start * width), f"<u{width}")


def packed(keys: np.ndarray, lengths: np.ndarray, payload: list[bytes], width: int) -> Iterator[bytes]:
    """The bytes of a file, part by part."""
    n, ends = len(keys), np.cumsum(lengths)
    salt, buckets = build_hash(keys)
    slots = np.zeros(n, dtype=SLOT)
    if n:
        at, prints = find_slots(keys, n, salt, buckets)
        slots["print"][at], slots["start"][at], slots["length"][at] = prints, ends - lengths, lengths
    n_ids = int(ends[-1]) if n else 0
    yield HEADER.pack(MAGIC, VERSION, width, n, n_ids, len(buckets), salt)
    yield from payload
    yield buckets.tobytes()
    yield slots.tobytes()
    yield keys.tobytes()


@lru_cache(maxsize=1)
def _encoder(tokenizer_json: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to Spark's tasks
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_json)
    return tokenizer, ChunkIds(tokenizer)


class ChunkIds:
    """Ids of texts, put together from those of their chunks between spaces and line feeds.

    Right for tokenizers that drop white space, so that no token and no normalisation
    reaches over it. Each distinct chunk is encoded by the tokenizer once, with others in
    one text; two generations of chunks bound the memory.
    """

    def __init__(self, tokenizer, size: int = 500_000, longest: int = 64):
        self.tokenizer, self.size, self.longest = tokenizer, size, longest
        vocabulary = tokenizer.get_vocab_size(with_added_tokens=True)
        self.width = 2 if vocabulary <= 1 << 16 else 4
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """The ids of each text; a null one is empty."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        spaced = pc.replace_substring(pc.fill_null(texts, ""), "\n", " ")
        rows = pc.split_pattern(spaced, " ")
        words = rows.flatten().dictionary_encode()
        ids = self._ids(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        # The ids of the distinct chunks one after the other; a text takes a run for each of its chunks.
        table = np.frombuffer(b"".join(ids), f"<u{self.width}")
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // self.width
        place = words.indices.to_numpy()
        size = sizes[place]
        upto = np.concatenate([[0], np.cumsum(size)])
        taken = table[np.repeat((np.cumsum(sizes) - sizes)[place] - upto[:-1], size) + np.arange(upto[-1])].tobytes()
        cuts = (upto[rows.offsets.to_numpy()] * self.width).tolist()
        return [taken[first:last] for first, last in zip(cuts, cuts[1:])]

    def _ids(self, chunks: list[str]) -> list[bytes]:
        """The ids of distinct chunks, from those encoded before or anew."""
        if len(self.young) > self.size:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        found = list(map(young.get, chunks))
        fresh = []
        for i in [i for i, ids in enumerate(found) if ids is None]:
            found[i] = old.get(chunks[i])
            if found[i] is None:
                fresh.append(i)
            else:
                young[chunks[i]] = found[i]
        for i, ids in zip(fresh, self._fresh([chunks[i] for i in fresh]), strict=True):
            found[i] = ids
            if len(chunks[i]) <= self.longest:
                young[chunks[i]] = ids
        return found

    def _fresh(self, chunks: list[str]) -> Iterator[bytes]:
        """The ids of each chunk: a call or a text for each would cost more than the chunk.

        In a text of many, a token belongs to the chunk that it begins in.
        """
        form, width = f"<u{self.width}", self.width
        groups = [chunks[at : at + JOINED] for at in range(0, len(chunks), JOINED)]
        encodings = self.tokenizer.encode_batch([" ".join(g) for g in groups], add_special_tokens=False)
        for group, e in zip(groups, encodings, strict=True):
            begins = [begin for begin, _ in e.offsets]
            if begins != sorted(begins):
                # Tokens that do not follow the text cannot be dealt to its chunks.
                for one in self.tokenizer.encode_batch_fast(group, add_special_tokens=False):
                    yield np.array(one.ids, dtype=form).tobytes()
                continue
            ids, first, end = np.array(e.ids, dtype=form).tobytes(), 0, 0
            for chunk in group:
                end += len(chunk) + 1
                last = bisect_left(begins, end, first)
                yield ids[first * width : last * width]
                first = last


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else fs.FileSystem.from_uri(f"file://{path}")


def _put(path: str, parts: Iterator[bytes]) -> None:
    """Writes under a name of its own and moves it: a task that runs twice leaves one file."""
    system, place = _open(path)
    own = f"{place}.{uuid.uuid4().hex}"
    with system.open_output_stream(own) as out:
        for part in parts:
            out.write(part)
    system.move(own, place)


def write_files(
    df: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int | None = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    file_bytes: int = 64 << 20,
) -> DataFrame:
    """Encodes all texts, writes the files below ``folder`` and returns their manifest.

    Documents lie in ascending order of ``id_col``, nulls first, rows with equal ids in the
    order of their text's hash. A null text is an empty one; ``end_id`` is put after each
    document. Rows are dealt by range of the id, and a task closes a file when its ids
    exceed ``file_bytes``. An empty table writes no file.

    Manifest: ``part``, ``file`` (their order is that of the documents), ``path``,
    ``first_id``, ``last_id``, ``n_docs``, ``n_ids`` and ``base``, the number of ids in all
    earlier files.
    """
    spark = df.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        sent = spark.sparkContext.broadcast(f.read())
    if "://" not in folder or folder.startswith("file:"):
        os.makedirs(folder.removeprefix("file://"), exist_ok=True)
    else:
        system, place = _open(folder)
        system.create_dir(place)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, encoder = _encoder(sent.value)
        width = encoder.width
        end = b"" if end_id is None else np.array([end_id], dtype=f"<u{width}").tobytes()
        part, files = TaskContext.get().partitionId(), []
        keys: list[tuple[int, int, bool]] = []
        lengths: list[int] = []
        payload: list[bytes] = []
        size, last, repeat = 0, (0, False), -1

        def close() -> None:
            nonlocal size
            path = f"{folder}/ids-{part:05d}-{len(files):04d}.bin"
            counts = np.array(lengths, dtype=np.int64)
            _put(path, packed(np.array(keys, dtype=KEY), counts, payload, width))
            known = [k[0] for k in keys if not k[2]] or [None]
            files.append((part, len(files), path, known[0], known[-1], len(keys), int(counts.sum())))
            keys.clear(), lengths.clear(), payload.clear()
            size = 0

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for at in range(0, len(ids), 256):
                found = ids.slice(at, 256).to_pylist()
                coded = encoder.encode(texts.slice(at, 256))
                for doc_id, own in zip(found, coded, strict=True):
                    key = (doc_id or 0, doc_id is None)
                    repeat = repeat + 1 if key == last and repeat >= 0 else 0
                    last = key
                    keys.append((key[0], repeat, key[1]))
                    payload.append(own + end)
                    lengths.append(len(payload[-1]) // width)
                    size += len(payload[-1])
                if size >= file_bytes:
                    close()
        if keys:
            close()
        if files:
            names = ["part", "file", "path", "first_id", "last_id", "n_docs", "n_ids"]
            types = [pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 4]
            columns = [pa.array(c, t) for c, t in zip(zip(*files, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"))
    rows = rows.repartitionByRange("id", "h").sortWithinPartitions("id", "h").select("id", "text")
    manifest = stored(rows.mapInArrow(write, MANIFEST), "manifest")
    # One row per file, not per document.
    earlier = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))


def read_files(manifest: DataFrame) -> DataFrame:
    """Reads the files of a manifest, each document through the index.

    Per document: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and
    ``ids_crc32`` (unsigned, of the ids as little-endian unsigned 32-bit integers).
    """
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                system, place = _open(path)
                with system.open_input_file(place) as f:
                    opened = IdFile(f.read())
                here, start, length = opened.spans(opened.keys)
                if not here.all():
                    raise ValueError(f"the index of {path} does not fit its keys")
                crcs = [
                    zlib.crc32(opened.payload[s : s + n].astype("<u4").tobytes())
                    for s, n in zip(start.tolist(), length.tolist(), strict=True)
                ]
                missing = opened.keys["null"].astype(bool)
                columns = [
                    pa.array(opened.keys["doc_id"].astype(np.int64), mask=missing),
                    pa.array(start + base),
                    pa.array(length),
                    pa.array(crcs, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    # A file a task: what is read is named by the manifest only.
    spread = manifest.select("path", "base").repartition("path")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def fetch(manifest: DataFrame, doc_ids: Sequence[int]) -> DataFrame:
    """The ids of the named documents: ``doc_id``, ``repeat`` and ``ids``.

    Only files whose range holds one of the keys are opened, and in them only the header,
    one bucket, one slot and the document itself are read. Rows that share an id follow
    one another as repeats 0, 1, ...; unknown ids give no row.
    """
    wanted = sorted(set(doc_ids))
    keys = F.array(*[F.lit(i).cast("long") for i in wanted])
    within = F.filter(keys, lambda k: k.between(F.col("first_id"), F.col("last_id")))
    asked = manifest.select("path", within.alias("keys")).where(F.size("keys") > 0)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, int, list[int]]] = []
            for path, own in zip(batch.column("path").to_pylist(), batch.column("keys").to_pylist(), strict=True):
                system, place = _open(path)
                with system.open_input_file(place) as f:
                    for doc_id in own:
                        repeat = 0
                        while (ids := read_ids(f, doc_id, repeat)) is not None:
                            found.append((doc_id, repeat, ids.tolist()))
                            repeat += 1
            columns = zip(*found, strict=True) if found else ([], [], [])
            types = (pa.int64(), pa.int32(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "repeat", "ids"]
            )

    return asked.mapInArrow(read, "doc_id long, repeat int, ids array<long>")
