"""Token files, packing and shards: exact round trips."""

import json
import random
import struct
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tables import document, frame, odd_documents, some_documents

from marquee.llm import feistel_shards
from marquee.llm.feistel_shards import grid, permuted, shard_rows, write_shards
from marquee.llm.queries import op8_feistel_shards
from marquee.llm.token_frames import (
    FrameReader,
    file_system,
    read_token_files,
    token_file_digests,
    tokenizer_path,
    write_token_files,
)
from marquee.llm.tokens import WordEncoder
from marquee.llm.window_packing import HARD_CUT, SENTENCE_CUT, best_cuts, cut_points, pack_documents, tail_lengths


def rows_of(rows, key=lambda row: tuple(map(str, row))):
    return sorted((tuple(row) for row in rows), key=key)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def whole_ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


DOCUMENTS = some_documents() + odd_documents()


def test_words_encoded_apart_give_the_ids_of_whole_texts(tokenizer):
    import pyarrow as pa

    texts = [row[1] or "" for row in DOCUMENTS] + ["don't I'LL we've. x,y;z!? 12,5", "a\vb\fc\r\nd"]
    encoder = WordEncoder(tokenizer_path())
    for _ in range(2):  # the second time all words are remembered
        offsets, ids, ends = encoder.encode(pa.array(texts))
        for k, text in enumerate(texts):
            own = ids[offsets[k] : offsets[k + 1]].tolist()
            assert own == tokenizer.encode(text, add_special_tokens=False).ids, text
        assert ends.sum() > 50


def test_other_tokenizers_get_whole_texts():
    import pyarrow as pa
    from tokenizers import Tokenizer

    from marquee.llm.tokens import goes_word_by_word

    other = tokenizer_path().replace("word_bpe_49k", "byte_bpe_50k")
    encoder, plain = WordEncoder(other), Tokenizer.from_file(other)
    assert WordEncoder(tokenizer_path()).by_words and not encoder.by_words
    texts = ["Upper and  lower", "", "a\nb", "don't. <|endoftext|>", "É é"]
    offsets, ids, ends = encoder.encode(pa.array(texts))
    for k, text in enumerate(texts):
        assert ids[offsets[k] : offsets[k + 1]].tolist() == plain.encode(text, add_special_tokens=False).ids
    assert not ends.any() and len(ends) == len(ids)
    settings = json.loads(Path(tokenizer_path()).read_text())
    assert goes_word_by_word(settings)
    for change in ({"normalizer": None}, {"pre_tokenizer": None}, {"truncation": {"max_length": 5}},
                   {"model": settings["model"] | {"dropout": 0.1}}):
        assert not goes_word_by_word(settings | change)


def test_s3a_is_a_name_of_s3():
    store, path = file_system("s3a://bucket/a/b.zst?region=eu-west-1")
    assert store.type_name == "s3" and path == "bucket/a/b.zst"


def test_token_files_read_back(spark, tokenizer, tmp_path):
    files = write_token_files(frame(spark, DOCUMENTS), str(tmp_path), tokenizer_path(), 2)
    got = read_token_files(files).collect()
    want = [(row[0], whole_ids(tokenizer, row[1])) for row in DOCUMENTS]
    assert rows_of((row.doc_id, list(row.ids)) for row in got) == rows_of(want)
    ordered = sorted(got, key=lambda row: row.start)
    ids = [row.doc_id for row in ordered]
    assert ids[:2] == [None, None] and ids[2:] == sorted(ids[2:])
    assert [row.start for row in ordered] == np.cumsum([0] + [row.n_tokens for row in ordered])[:-1].tolist()
    digests = {(row.doc_id, row.start): row.ids_crc32 for row in token_file_digests(files).collect()}
    for row in got:
        assert digests[row.doc_id, row.start] == zlib.crc32(struct.pack(f"<{len(row.ids)}I", *row.ids))


def test_only_frames_of_the_documents_asked_for_are_decompressed(spark, tokenizer, tmp_path, monkeypatch):
    from pyarrow import fs

    rows = [document(k, text) for k, text in enumerate(["word " * 70_000, "x y", "z " * 70_000])]
    files = write_token_files(frame(spark, rows).coalesce(1), str(tmp_path), tokenizer_path(), 2).collect()
    asked = files[-1]
    read = []
    frame_of = FrameReader.frame
    monkeypatch.setattr(FrameReader, "frame", lambda self, n: read.append(n) or frame_of(self, n))
    reader = FrameReader(fs.LocalFileSystem().open_input_file(asked.file))
    last = len(reader.doc_ids) - 1
    assert next(reader.documents([last]))[1].tolist() == whole_ids(tokenizer, rows[-1][1])
    assert len(read) < asked.frames or asked.documents == 1
    wanted = read_token_files(spark.createDataFrame(files), [1, 99]).collect()
    assert [(row.doc_id, list(row.ids)) for row in wanted] == [(1, whole_ids(tokenizer, "x y"))]


def test_files_are_plain_zstandard_and_checked(spark, tokenizer, tmp_path):
    import zstandard
    from pyarrow import fs

    files = write_token_files(frame(spark, DOCUMENTS[:30]), str(tmp_path), tokenizer_path(), 2)
    file = files.orderBy("part").first().file
    data = bytearray(open(file, "rb").read())
    plain = zstandard.ZstdDecompressor().stream_reader(bytes(data), read_across_frames=True).read()
    assert len(plain) == 4 * files.orderBy("part").first().ids
    reader = FrameReader(fs.LocalFileSystem().open_input_file(file))
    reader.checksums = reader.checksums + 1
    with pytest.raises(ValueError, match="checksum"):
        reader.frame(0)


def test_no_documents_no_files(spark, tmp_path):
    files = write_token_files(frame(spark, []), str(tmp_path), tokenizer_path(), 2)
    assert files.count() == 0 and token_file_digests(files).count() == 0


def least_cost(points, penalty, size):
    """Plain dynamic programming over all cuts."""
    places, fines = [0, *points], [0, *penalty]
    cost = [0] + [10**9] * len(points)
    for j in range(1, len(places)):
        for i in range(j):
            if places[j] - places[i] <= size:
                cost[j] = min(cost[j], cost[i] + size - (places[j] - places[i]) + fines[j])
    return cost[-1]


@pytest.mark.parametrize("seed", range(30))
def test_cuts_are_the_cheapest(seed):
    rng = random.Random(seed)
    total, size = rng.randint(1, 400), rng.choice([7, 40, 100])
    offsets = np.array(sorted({0, total, *(rng.randint(0, total) for _ in range(rng.randint(0, 10)))}))
    ends = np.array(sorted({rng.randint(1, total) for _ in range(rng.randint(0, 30))}), dtype=np.int64)
    points, penalty = cut_points(offsets, ends, size)
    assert points[-1] == total and np.diff(np.append(0, points)).max() <= size
    cuts = [0, *best_cuts(points, penalty, size)]
    fines = dict(zip(points.tolist(), penalty.tolist()))
    assert all(b - a <= size for a, b in zip(cuts, cuts[1:]))
    assert sum(size - (b - a) + fines[b] for a, b in zip(cuts, cuts[1:])) == least_cost(points, penalty, size)
    assert {fines[p] for p in fines if p in offsets} == {0}
    assert set(penalty.tolist()) <= {0, SENTENCE_CUT, HARD_CUT}


def test_tails():
    for rest in range(1, 4097):
        lengths = tail_lengths(rest)
        assert sum(lengths) == rest
        padding = lambda n: 0 if n & (n - 1) == 0 else 4096 - n
        assert sum(map(padding, lengths)) + HARD_CUT * (len(lengths) - 1) <= padding(rest)
    assert tail_lengths(0) == [] and tail_lengths(4000) == [4000]


@pytest.mark.parametrize("size", [64, 4096])
def test_every_id_is_in_one_piece(spark, tokenizer, size):
    pieces = pack_documents(frame(spark, DOCUMENTS), tokenizer_path(), 2, size).collect()
    texts, places = defaultdict(list), defaultdict(list)
    for row in pieces:
        places[row.sequence_id].append((row.offset, row.length))
        texts[row.doc_id].append(row)
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    want = defaultdict(list)
    for row in DOCUMENTS:
        want[row[0]].append(whole_ids(tokenizer, row[1]))
    assert set(texts) == set(want)
    for doc_id, several in want.items():
        assert sum(row.length for row in texts[doc_id]) == sum(map(len, several))
        if len(several) == 1:
            at = 0
            for row in sorted(texts[doc_id], key=lambda row: row.start):
                part = several[0][at : at + row.length]
                assert row.start == at and row.doc_tokens == len(several[0])
                assert row.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
                at += row.length
    used = [sum(n for _, n in parts) for parts in places.values()]
    padding = sum(0 if n & (n - 1) == 0 else size - n for n in used)
    assert padding < 0.1 * sum(used)


def test_nothing_to_pack(spark):
    assert pack_documents(frame(spark, []), tokenizer_path(), 2).count() == 0


@pytest.mark.parametrize("rows", [0, 1, 2, 3, 7, 16, 17, 500])
def test_the_permutation_is_one_to_one(spark, rows):
    a, b = grid(rows)
    assert a * b >= rows and (a - 1) * b < max(rows, 1)
    got = [row[0] for row in spark.range(rows).select(permuted(F.col("id"), rows, 5)).collect()]
    assert sorted(got) == list(range(rows))
    if rows == 500:
        assert sum(x == y for x, y in zip(got, range(rows))) < 20
        other = [row[0] for row in spark.range(rows).select(permuted(F.col("id"), rows, 6)).collect()]
        assert other != got


def spark_hash(*values):
    """Spark's xxhash64 of integers, each as wide as given."""
    state = 42
    for value, width in values:
        state = xxhash.xxh64_intdigest(value.to_bytes(width, "little", signed=True), state)
    return state - (1 << 64) if state >> 63 else state


def plain_permuted(number, rows, seed, rounds=6):
    a, b = grid(rows)
    while True:
        left, right = number % a, number // a
        for turn in range(rounds):
            if turn % 2 == 0:
                left = (left + spark_hash((seed, 4), (turn, 4), (right, 8)) % a) % a
            else:
                right = (right + spark_hash((seed, 4), (turn, 4), (left, 8)) % b) % b
        number = left + right * a
        if number < rows:
            return number


@pytest.mark.parametrize("rows,steps", [(1, 64), (2, 64), (17, 64), (101, 64), (101, 1), (1000, 1)])
def test_the_network_equals_a_plain_one(spark, monkeypatch, rows, steps):
    # with few steps at first, walks go on by the loop for the rest
    monkeypatch.setattr(feistel_shards, "STEPS", steps)
    got = [row[0] for row in spark.range(rows).select(permuted(F.col("id"), rows, 5)).collect()]
    assert got == [plain_permuted(number, rows, 5) for number in range(rows)]


def test_the_query_equals_plain_sharding(spark, tmp_path):
    rows = [row for row in DOCUMENTS if row[0] is not None]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(row) for row in op8_feistel_shards(spark, str(tmp_path)).collect()]
    want = []
    for row in rows:
        data = (row[1] or "").encode()
        want.append((row[0], len(data) + 1, zlib.crc32(data)))
    want.sort(key=lambda row: (row[0], row[2], row[1]))
    expected = []
    for number, row in enumerate(want):
        at = plain_permuted(number, len(want), 8)
        expected.append((*row, "rows", at % 8, at // 8, None, number))
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_shards_are_even_and_slots_gapless(spark, tmp_path):
    docs = frame(spark, DOCUMENTS + DOCUMENTS[:20])
    sharded = shard_rows(docs, ["doc_id", "text"], 8, seed=3)
    assert sorted(sharded.columns) == sorted([*docs.columns, "row_number", "slot"])
    got = sharded.select("row_number", "shard", "slot", "doc_id", "text").collect()
    assert sorted(row.row_number for row in got) == list(range(docs.count()))
    by_number = sorted(got, key=lambda row: row.row_number)
    assert [row.doc_id for row in by_number if row.doc_id is not None] == sorted(
        row[0] for row in DOCUMENTS + DOCUMENTS[:20] if row[0] is not None
    )
    slots = defaultdict(list)
    for row in got:
        slots[row["shard"]].append(row.slot)
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    again = {tuple(row) for row in shard_rows(docs.repartition(7), ["doc_id", "text"], 8, seed=3)
             .select("row_number", "shard", "slot", "doc_id", "text").collect()}
    assert again == {tuple(row) for row in got}
    write_shards(sharded, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).groupBy("shard").count().count() == 8
    assert shard_rows(docs.limit(0), ["doc_id"], 8).count() == 0
