"""Token-id files: bit-plane shuffled blocks of ids, compressed plane by plane.

A file holds the ids of consecutive documents, cut into blocks of a fixed number of ids. A block's 32-bit ids are
transposed into planes, 4 of bytes or 32 of bits, least significant first, and each plane is compressed by itself: planes
that hardly vary take next to no room. Layout, numbers little-endian:

    b"RMTP0001"
    the planes of block 0, of block 1, ...            zstandard frames
    index: zstandard of one JSON object               kind, block_ids, blocks [[offset, ids, plane lengths]], documents
    length of the index (u64), b"RMTPEND1"

``documents`` lists each document's id (null where it has none) and its number of ids, in order.

Texts are encoded piece by white-space separated piece, which gives the ids of the whole text for vocabularies that drop
white space and never join across it; each worker keeps a bounded table of encoded pieces.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillmart.llm.common import held, written
from rillmart.session import run_folder

HEAD, TAIL = b"RMTP0001", b"RMTPEND1"
BLOCK_IDS = 1 << 16
FILE_IDS = 1 << 24  # a file is closed after the document that passes this many ids
KEPT_PIECES = 300_000  # of a worker process; as many again from before the last start
KEPT_COUNTS = 200_000  # the same where pieces are only counted, beside what a pipeline's other stages hold
PIECE_SPACES = " \t\n\r"  # where texts are cut
PARSE_CHARS = 1 << 20  # of text cut into pieces at once


# How word_bpe_49k.json cuts normalised text, for text of Latin letters alone; other text goes through the library's own cut.
LATIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ɏ]+|[0-9²³¹¼-¾]|[^\t-\r \x85\xa0a-zªµºß-öø-ɏ0-9²³¹¼-¾]+")
CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"  # fixed value, the pattern in the file


class _Kept(dict):
    """Values made on demand. When full, it starts anew and takes back what is asked for again."""

    def __init__(self, make, most: int):
        self.make, self.most, self.before = make, most, {}

    def __missing__(self, key: str) -> bytes:
        if len(self) >= self.most:
            self.before = dict(self)
            self.clear()
        found = self.before.get(key)
        self[key] = found = self.make(key) if found is None else found
        return found


# What ``ByteLevel`` writes for each byte: printable Latin-1 stands for itself, the others are 256, 257, ... in order.
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
AS_BYTES = {byte: 256 + n for n, byte in enumerate(sorted({*range(256)} - {*_PLAIN}))}


class _Cutter:
    """Encodes pieces by the steps of ``Tokenizer.encode``, without its offsets."""

    def __init__(self, tokenizer):
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.specials = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        known = json.loads(tokenizer.to_str())
        steps = (known.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.latin = steps[0].get("pattern") == {"Regex": CUT} and all(s[:1] == "<" for s in self.specials)
        normal = [n.get("type") for n in (known.get("normalizer") or {}).get("normalizers") or []]
        self.lowers = self.latin and normal == ["NFC", "Replace", "Lowercase"]
        self.pieces = _Kept(self._piece, KEPT_PIECES)
        self.marks = _Kept(self._part, KEPT_PIECES // 30)  # parts that are no letters

    @staticmethod
    def of(ids: list[int]) -> bytes:
        """What is kept of the ids of a piece."""
        return array("I", ids).tobytes()

    @staticmethod
    def joined(parts) -> bytes:
        return b"".join(parts)

    def _ids(self, cut) -> bytes:
        return self.of([t.id for part, _ in cut for t in self.model.tokenize(part)])

    def _part(self, part: str) -> bytes:
        # printable ASCII stands for itself
        if not (part.isascii() and part.isprintable()):
            part = part.encode().decode("latin-1").translate(AS_BYTES)
        return self.of([t.id for t in self.model.tokenize(part)])

    def _normal(self, piece: str) -> str:
        if self.latin and piece.isascii():
            return piece.lower()
        # up to this letter nothing composes, and all but one letter have one letter as lower case
        if self.lowers and max(piece) <= "ɏ" and "İ" not in piece:
            return piece.lower()
        return self.tokenizer.normalizer.normalize_str(piece)

    def _piece(self, piece: str) -> bytes:
        if not piece:
            return self.of([])
        if "<" in piece and any(s in piece for s in self.specials):
            return self.of(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        normal = self._normal(piece)
        if self.latin and max(normal, default="") <= "ɏ":
            if normal.isalpha():  # letters alone are one part
                return self._part(normal)
            # letters are likely to be a piece elsewhere
            return self.joined([self.pieces[p] if p.isalpha() else self.marks[p] for p in LATIN.findall(normal)])
        return self._ids(self.tokenizer.pre_tokenizer.pre_tokenize_str(normal))


class _Counter(_Cutter):
    """Keeps the number of ids of a piece in place of the ids, which takes no memory beside the piece's own."""

    of, joined = staticmethod(len), staticmethod(sum)

    def __init__(self, tokenizer):
        super().__init__(tokenizer)
        self.pieces.most = KEPT_COUNTS


class PieceEncoder:
    """Ids of texts as little-endian 32-bit integers, by a ``tokenizers`` file whose vocabulary drops white space."""

    cutter, joined = _Cutter, b"".join

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        # a worker that runs more tasks need not encode the same pieces again
        owner = f"{self.cutter.__name__} of {tokenizer_file}"
        self.known = held(owner, lambda: self.cutter(Tokenizer.from_file(tokenizer_file))).pieces

    def encode(self, texts: list[str]) -> list[bytes]:
        # two more keys make the getter return a tuple for any text
        return [self.joined(itemgetter("", "", *_pieces(text))(self.known)) for text in texts]

    def encode_all(self, texts: list[str | None]) -> Iterator[bytes]:
        """As ``encode``, a bounded number of characters at a time; null is empty."""
        waiting, size = [], 0
        for text in texts:
            text = text or ""
            if len(text) > PARSE_CHARS:
                yield from self.encode(waiting)
                waiting, size = [], 0
                yield self.joined(b for part in _slices(text) for b in self.encode([part]))
                continue
            waiting.append(text)
            size += len(text)
            if size > PARSE_CHARS:
                yield from self.encode(waiting)
                waiting, size = [], 0
        yield from self.encode(waiting)


class PieceCounter(PieceEncoder):
    """Numbers of ids of texts, by the same steps as ``PieceEncoder``."""

    cutter, joined = _Counter, staticmethod(sum)


def _pieces(text: str) -> list[str]:
    """Split at ASCII white space only: whether other spaces count is for the tokenizer to say.

    ASCII text is lower-cased as the tokenizer will do, which makes fewer pieces; not where that could make a special token.
    """
    if text.isascii() and "<|" not in text:
        text = text.lower()
    for c in PIECE_SPACES[1:]:
        text = text.replace(c, " ")
    return list(filter(None, text.split(" ")))


def _slices(text: str) -> Iterator[str]:
    """Parts of a very long text, cut at white space."""
    start = 0
    while start < len(text):
        end = start + PARSE_CHARS
        if end < len(text):
            ends = [p for c in PIECE_SPACES if (p := text.find(c, end)) >= 0]
            end = min(ends, default=len(text))
        yield text[start:end]
        start = end


def planes_of(ids: np.ndarray, kind: str) -> list[bytes]:
    rows = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if kind == "bit":
        rows = np.packbits(np.unpackbits(rows, axis=1, bitorder="little"), axis=0)
    return [plane.tobytes() for plane in rows.T]


def ids_of(planes: list[bytes], count: int, kind: str) -> np.ndarray:
    rows = np.empty((len(planes[0]), len(planes)), dtype=np.uint8)
    for n, plane in enumerate(planes):
        rows[:, n] = np.frombuffer(plane, dtype=np.uint8)
    if kind == "bit":
        rows = np.packbits(np.unpackbits(rows, axis=0)[:count], axis=1, bitorder="little")
    return rows.reshape(-1).view("<u4")


class TokenFile:
    """Writes one file to an output stream, block by block."""

    def __init__(self, stream, kind: str, block_ids: int):
        self.stream, self.kind, self.block_ids = stream, kind, block_ids
        self.press = zstandard.ZstdCompressor(level=1)
        self.documents: list[tuple[int | None, int]] = []
        self.blocks: list[tuple[int, int, list[int]]] = []
        self.waiting, self.held, self.n_ids = [], 0, 0
        self.at = len(HEAD)
        stream.write(HEAD)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.documents.append((doc_id, len(ids) // 4))
        self.waiting.append(ids)
        self.held += len(ids) // 4
        self.n_ids += len(ids) // 4
        if self.held >= self.block_ids:
            self._flush(False)

    def _flush(self, all_of_it: bool) -> None:
        ids = np.frombuffer(b"".join(self.waiting), dtype="<u4")
        done = 0
        while len(ids) - done >= self.block_ids or all_of_it and done < len(ids):
            block = ids[done : done + self.block_ids]
            planes = [self.press.compress(p) for p in planes_of(block, self.kind)]
            self.blocks.append((self.at, len(block), [len(p) for p in planes]))
            for p in planes:
                self.stream.write(p)
                self.at += len(p)
            done += len(block)
        self.waiting, self.held = [ids[done:].tobytes()], len(ids) - done

    def close(self) -> None:
        self._flush(True)
        index = {"kind": self.kind, "block_ids": self.block_ids, "blocks": self.blocks, "documents": self.documents}
        index = self.press.compress(json.dumps(index).encode())
        self.stream.write(index + struct.pack("<Q", len(index)) + TAIL)
        self.stream.close()


def read_documents(content: bytes) -> Iterator[tuple[int | None, int, int, int]]:
    """(id, ids before it in the file, its number of ids, their crc32) of each document, one block in memory at a time."""
    if content[: len(HEAD)] != HEAD or content[-len(TAIL) :] != TAIL:
        raise ValueError("not a complete token file")
    (length,) = struct.unpack("<Q", content[-len(TAIL) - 8 : -len(TAIL)])
    press = zstandard.ZstdDecompressor()
    index = json.loads(press.decompress(content[-len(TAIL) - 8 - length : -len(TAIL) - 8]))

    def parts() -> Iterator[memoryview]:
        for at, count, lengths in index["blocks"]:
            planes = []
            for n in lengths:
                planes.append(press.decompress(content[at : at + n]))
                at += n
            yield memoryview(ids_of(planes, count, index["kind"])).cast("B")

    blocks, block, used, start = parts(), b"", 0, 0
    for doc_id, count in index["documents"]:
        left, crc = count * 4, 0
        while left:
            if used == len(block):
                block, used = next(blocks), 0
            piece = block[used : used + left]
            crc, used, left = zlib.crc32(piece, crc), used + len(piece), left - len(piece)
        yield doc_id, start, count, crc
        start += count


def write_token_files(
    docs: DataFrame, tokenizer_file: str, end_id: int, folder: str, id_col: str = "doc_id", text_col: str = "text",
    kind: str = "byte", block_ids: int = BLOCK_IDS, file_ids: int = FILE_IDS,
) -> DataFrame:
    """Write the ids of all texts, each followed by ``end_id``, in ascending id order; (file, shard, part, n_ids) of each file.

    Null text is empty. Null ids come first; rows with equal ids stand in the order of a hash of their text. A task writes
    its files under other names and renames them when whole, so that one that is run again replaces what it left. An empty
    table writes no file. ``folder`` must be a path or URI that ``pyarrow.fs`` and Spark both reach.
    """
    if kind not in ("byte", "bit"):
        raise ValueError("kind must be byte or bit")

    def write(frames):
        from pyarrow.fs import FileSystem

        store, root = FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        context = TaskContext.get()
        shard, encoder, part, file = context.partitionId(), PieceEncoder(tokenizer_file), 0, None
        end = np.array([end_id], dtype="<u4").tobytes()

        def done():
            file.close()
            name = f"shard-{shard:07d}-{part:05d}.tok"
            if store.get_file_info(f"{root}/{name}").is_file:
                store.delete_file(f"{root}/{name}")
            store.move(draft, f"{root}/{name}")
            return pd.DataFrame({"file": [name], "shard": [shard], "part": [part], "n_ids": [file.n_ids]})

        for frame in frames:
            for doc_id, found in zip(frame["doc_id"], encoder.encode_all(frame["text"].tolist()), strict=True):
                if file is None:
                    draft = f"{root}/.draft-{shard}-{part}-{context.taskAttemptId()}"
                    file = TokenFile(store.open_output_stream(draft), kind, block_ids)
                file.add(None if doc_id is None else int(doc_id), found + end)
                if file.n_ids >= file_ids:
                    yield done()
                    file, part = None, part + 1
        if file is not None:
            yield done()

    turn = F.xxhash64("text")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange("doc_id", turn).sortWithinPartitions("doc_id", turn)
    rows = rows.select(F.col("doc_id").cast("string"), "text")  # as pandas has no integer column with nulls
    return written(rows.mapInPandas(write, "file STRING, shard INT, part INT, n_ids BIGINT"), "token_manifest")


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, read from the files; start counts over all files in order."""

    def read(frames):
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                out = pd.DataFrame(list(read_documents(content)), columns=["doc_id", "start", "n_tokens", "ids_crc32"])
                yield out.assign(doc_id=out["doc_id"].astype("Int64"), file=path.rpartition("/")[2])

    order = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    bases = manifest.select("file", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("base"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(folder) if not manifest.isEmpty() else None
    schema = "doc_id BIGINT, start BIGINT, n_tokens BIGINT, ids_crc32 BIGINT, file STRING"
    if files is None:
        return spark.createDataFrame([], schema).drop("file")
    read_back = files.select("path", "content").mapInPandas(read, schema)
    return read_back.join(bases, "file").select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


def token_files_folder(spark: SparkSession) -> str:
    return run_folder(spark, "token_files")
