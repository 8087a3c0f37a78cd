"""Token files, byte-level BPE and packing: round trips against the libraries, invariants, odd documents."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from odd import documents, nothing, texts
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rillmart.llm import byte_bpe, common, packing, token_files
from rillmart.llm.queries import REGISTRY

WORDS, RANKS = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [
    "", " ", "a\x1cb", "x　y z", "Ünïcode's Straße ΑΣ ΑΣ. éx", "<|endoftext|>a <|STARTOFTEXT|> <|startoftext|>", "'Sup it's WE'LL",
    "\x01 \x7f\t\r\nq\x0bq\x0cr\x85s", "İstanbul ǅ ﬁ ½ ²x ٣٤ 你好吗", "à ́b", "  two  spaces \n\n lines", "\u2003em\u2028sep\ufeff", "😀👍🏽 ok",
]


def test_pieces_give_the_ids_of_the_whole_text(monkeypatch):
    samples = ODD + [t for _, t, _ in texts() if t]
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in Tokenizer.from_file(WORDS).encode_batch(samples, add_special_tokens=False)]
    assert list(token_files.PieceEncoder(WORDS).encode_all(samples)) == want
    monkeypatch.setattr(token_files, "KEPT_PIECES", 3)
    monkeypatch.setattr(token_files, "PARSE_CHARS", 100)
    monkeypatch.setattr(common, "_HELD", {})
    assert list(token_files.PieceEncoder(WORDS).encode_all(samples)) == want
    assert list(token_files.PieceEncoder(WORDS).encode_all([None])) == [b""]


def test_a_word_is_encoded_once_whatever_marks_are_beside_it():
    cutter, seen = token_files._Cutter(Tokenizer.from_file(WORDS)), []

    class Model:
        def tokenize(self, part, model=cutter.model):
            seen.append(part)
            return model.tokenize(part)

    cutter.model = Model()
    text = "wortig (wortig) wortig, Wortig. größig GRÖSSIG größig! Größig"
    ids = b"".join(cutter.pieces[p] for p in token_files._pieces(text))
    assert np.frombuffer(ids, dtype="<u4").tolist() == Tokenizer.from_file(WORDS).encode(text, add_special_tokens=False).ids
    assert seen.count("wortig") == 1 and len(seen) == len({*seen}) + 1  # "Größig" differs from "größig" as a piece only


def test_latin_letters_are_normalised_and_written_as_the_library_does():
    tokenizer, cutter = Tokenizer.from_file(WORDS), token_files._Cutter(Tokenizer.from_file(WORDS))
    letters = [chr(c) for c in range(0x21, 0x250)]
    for piece in [*letters, *["a" + c + "b." for c in letters], "".join(letters)]:
        want = tokenizer.encode(piece, add_special_tokens=False).ids
        assert np.frombuffer(cutter.pieces[piece], dtype="<u4").tolist() == want, piece


def test_counting_keeps_no_ids(monkeypatch):
    monkeypatch.setattr(common, "_HELD", {})
    samples = ODD + [t for _, t, _ in texts() if t]
    counter = token_files.PieceCounter(WORDS)
    want = [len(e.ids) for e in Tokenizer.from_file(WORDS).encode_batch(samples, add_special_tokens=False)]
    assert list(counter.encode_all(samples)) == want and list(counter.encode_all([None, ""])) == [0, 0]
    assert counter.known and all(type(n) is int for n in counter.known.values())
    monkeypatch.setattr(token_files, "PARSE_CHARS", 100)
    assert list(counter.encode_all(samples)) == want


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("count", [1, 7, 8, 1000])
def test_planes_and_back(kind, count):
    ids = np.random.default_rng(2).integers(0, 1 << 32, count, dtype=np.uint64).astype("<u4")
    assert (token_files.ids_of(token_files.planes_of(ids, kind), count, kind) == ids).all()


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_files_of_odd_documents(spark, kind):
    to = token_files.token_files_folder(spark)
    manifest = token_files.write_token_files(documents(spark), WORDS, 2, to, kind=kind, block_ids=64, file_ids=500)
    assert manifest.count() > 3
    got = sorted(token_files.read_token_files(spark, to, manifest).collect(), key=lambda r: r.start)
    encode = Tokenizer.from_file(WORDS).encode
    want = [(i, [*encode(t or "", add_special_tokens=False).ids, 2]) for i, t, _ in texts()]
    crc = lambda ids: zlib.crc32(np.array(ids, dtype="<u4").tobytes())
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((i, len(x), crc(x)) for i, x in want)
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got[:-1]]]).tolist()
    order = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert order == sorted(order)


def test_no_documents_no_files(spark):
    to = token_files.token_files_folder(spark)
    manifest = token_files.write_token_files(nothing(spark), WORDS, 2, to)
    assert manifest.count() == 0 and token_files.read_token_files(spark, to, manifest).count() == 0
    with pytest.raises(ValueError):
        token_files.write_token_files(nothing(spark), WORDS, 2, to, kind="nibble")
    with pytest.raises(ValueError):
        list(token_files.read_documents(b"RMTP0001 cut short"))


def test_query_6(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").toPandas().sort_values("doc_id")
    ids = [[*e.ids, 2] for e in Tokenizer.from_file(WORDS).encode_batch(docs["text"].tolist(), add_special_tokens=False)]
    got = REGISTRY["op6_token_files"](spark, "/root/testdata/sf0.001").toPandas().sort_values("doc_id")
    assert got["n_tokens"].tolist() == [len(x) for x in ids]
    assert got["start"].tolist() == np.cumsum([0, *[len(x) for x in ids[:-1]]]).tolist()
    assert got["ids_crc32"].tolist() == [zlib.crc32(np.array(x, dtype="<u4").tobytes()) for x in ids]


def test_bpe_equals_the_library(spark):
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.ranks_of(RANKS), special_tokens={})
    samples = ODD + [t for _, t, _ in texts() if len(t or "") < 40_000] + [None, "abc" * 60, "naïve " * 9]
    rows = spark.createDataFrame([(n, t, "clash") for n, t in enumerate(samples)], "n INT, text STRING, parts STRING").repartition(4)
    for frequent in (1, 500):
        df, pairs = byte_bpe.encoded(rows, RANKS, public_tokenizers.PATTERN, frequent=frequent)
        for r in df.withColumn("back", pairs.decode(F.col("token_ids"))).collect():
            want = encoding.encode_ordinary(samples[r.n] or "")
            assert r.token_ids == " ".join(map(str, want)) and bytes(r.back) == (samples[r.n] or "").encode(), samples[r.n]
    empty, pairs = byte_bpe.encoded(rows.where("false"), RANKS, public_tokenizers.PATTERN)
    assert empty.withColumn("back", pairs.decode(F.col("token_ids"))).count() == 0


def test_query_8(spark):
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.ranks_of(RANKS), special_tokens={})
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    digest = lambda b: hashlib.sha256(b).hexdigest()
    want = {(d.doc_id, len(i := encoding.encode_ordinary(d.text)), digest(" ".join(map(str, i)).encode()), digest(d.text.encode())) for d in docs}
    assert {tuple(r) for r in REGISTRY["op8_byte_bpe"](spark, "/root/testdata/sf0.001").collect()} == want


def check_packing(rows, lengths, capacities):
    covered, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        bins[r.bin_id, r.bin_capacity].append((r.bin_offset, r.piece_tokens))
        covered[r.doc_id].append((r.piece_start, r.piece_tokens))
    assert len(bins) == len({b for b, _ in bins})
    for (_, capacity), pieces in bins.items():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert capacity == min(c for c in capacities if c >= at)
    got = Counter({i: sum(n for _, n in pieces) for i, pieces in covered.items()})
    assert got == Counter(lengths)
    return sum(c for _, c in bins), sum(lengths.values())


def test_packing_of_odd_lengths(spark):
    sizes = [(n, (n * 37) % 120) for n in range(300)] + [(1000, 1050), (1001, 100), (None, 7), (1002, None), (1003, -4)]
    df = spark.createDataFrame(sizes, "doc_id BIGINT, n_tokens INT").withColumns({"piece": F.lit("x"), "shard": F.lit(5), "row": F.lit(1)})
    want = {i: max(0, n or 0) for i, n in sizes}
    for shard_pieces in (40_000, 60):
        rows = packing.pack_documents(df, (100, 25, 50), shard_pieces=shard_pieces).collect()
        held, tokens = check_packing(rows, want, (25, 50, 100))
        assert held < 1.1 * tokens
    repeated = packing.pack_documents(df.union(df), (100, 25, 50)).collect()
    assert len(repeated) == 2 * len(rows)
    assert packing.pack_documents(df.where("false")).count() == 0
    with pytest.raises(ValueError):
        packing.pack_documents(df, (0, 5))


def test_best_fit_takes_the_tightest_bin_and_the_cheapest_size():
    cost = packing.Cost(fixed=10, square=0.01)  # of 16, 32, 64: 32 is the least a token
    bins, offsets, final = packing.pack(np.array([20, 25, 7, 12, 1]), (16, 32, 64), cost)
    assert bins[0] != bins[1] and bins[2] == bins[1] and bins[3] == bins[0]
    assert offsets[1] == 0 and offsets[2] == 25 and offsets[3] == 20
    assert all(f in (16, 32, 64) for f in final)


def test_query_3(spark):
    size = packing.token_count(WORDS, F.col("text"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lengths = {r.doc_id: r.n for r in docs.select("doc_id", size.alias("n")).collect()}
    held, tokens = check_packing(REGISTRY["op3_best_fit_packing"](spark, "/root/testdata/sf0.001").collect(), lengths, packing.CAPACITIES)
    assert held < 1.05 * tokens


def plain_best_fit(sizes, capacities, cost):
    """Bins of pieces by falling size, by looking at every open bin; of equally full ones the one touched last."""
    bins, left, touched = [], sum(sizes), 0
    for at in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[at]
        fit = [b for b in bins if b["room"] >= size]
        if fit:
            b = min(fit, key=lambda b: (b["room"], -b["touched"]))
        else:
            space = min((c for c in capacities if c >= size), key=lambda c: (cost.of(c) / max(1, min(c, left)), c))
            b = {"room": space, "held": 0, "pieces": [], "touched": 0}
            bins.append(b)
        b["pieces"].append((at, b["held"]))
        touched += 1
        b["room"], b["held"], b["touched"] = b["room"] - size, b["held"] + size, touched
        left -= size
    return [(sorted(b["pieces"]), min(c for c in capacities if c >= b["held"])) for b in bins]


@pytest.mark.parametrize("seed", range(12))
def test_packing_equals_a_plain_best_fit(seed):
    rng = np.random.default_rng(seed)
    capacities = ((512, 1024, 2048, 4096), (7,), (4, 9, 10, 64))[seed % 3]
    sizes = np.minimum(rng.integers(0, capacities[-1] + 1, 400) // rng.integers(1, 9, 400), capacities[-1])
    cost = packing.Cost(*((128.0, 1 / 8192), (0.0, 0.0), (5.0, 0.1))[seed // 4])
    bins, offsets, final = packing.pack(sizes, capacities, cost)
    got = [(sorted((int(at), int(offsets[at])) for at in np.nonzero(bins == b)[0]), int(final[b])) for b in range(len(final))]
    assert got == plain_best_fit(sizes.tolist(), capacities, cost)
