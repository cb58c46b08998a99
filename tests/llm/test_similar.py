"""Near-duplicates, benchmark passages and nearest neighbours against brute force."""

import random
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pigeonhole
import pyarrow as pa
import pytest
from tables import document, frame, odd_documents, prose, some_documents
from test_models import words_of

from corpus_pipeline import drop_leaks
from marquee.llm import chosen_path, decontamination, multi_index
from marquee.llm.chosen_path import linked_sets, near_duplicates, shingle_sets
from marquee.llm.components import components
from marquee.llm.decontamination import (
    EDITS,
    RECALL,
    build_index,
    contaminated,
    edit_distance,
    embed_item,
    embed_items,
    find_passages,
    met_places,
    walks,
)
from marquee.llm.multi_index import SubstringIndex, learn_codes, nearest
from marquee.llm.queries import op4_edit_decontamination
from marquee.llm.text import hash_words


def plain_shingles(text):
    words = words_of(text)
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def linked(a, b):
    common = len(a & b)
    return bool(a and b) and 100 * common >= 85 * (len(a) + len(b) - common)


def plain_components(rows):
    sets = [plain_shingles(row[1]) for row in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if root(i) != root(j) and linked(sets[i], sets[j]):
                parent[root(i)] = root(j)
    ids = defaultdict(list)
    for k, row in enumerate(rows):
        ids[root(k)].append(row[0])
    least = {r: min((x for x in own if x is not None), default=None) for r, own in ids.items()}
    return [(row[0], len(sets[k]), least[root(k)], row[0] == least[root(k)]) for k, row in enumerate(rows)]


def copies(rng, base, count, first, edits):
    rows = []
    for k in range(count):
        words = base.split()
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
        rows.append(document(first + k, " ".join(words)))
    return rows


def planted(seed):
    rng = random.Random(seed)
    rows = some_documents(seed, 60) + odd_documents()
    for group in range(6):
        rows += copies(rng, prose(rng, "en", rng.randint(60, 200)), 12, 2000 + 100 * group, 4)
    passage = prose(rng, "en", 40)
    rows += [document(4000 + k, f"{passage} {prose(rng, 'en', rng.randint(5, 60))}") for k in range(40)]
    rng.shuffle(rows)
    return rows


def as_rows(df):
    return Counter(tuple(row)[:4] for row in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = planted(seed)
    want = plain_components(rows)
    assert 40 < sum(row[3] for row in want) < len(rows) - 20
    assert as_rows(near_duplicates(frame(spark, rows))) == Counter(want)


def test_large_and_loose_groups_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "SMALL_NODE", 4)
    monkeypatch.setattr(chosen_path, "BLOCK", 16)
    rng = random.Random(8)
    base = prose(rng, "en", 120)
    # from equal to far apart: most pairs are no links, most documents are connected
    rows = copies(rng, base, 150, 0, 6) + copies(rng, base, 30, 500, 25)
    assert as_rows(near_duplicates(frame(spark, rows))) == Counter(plain_components(rows))


def test_carried_columns_and_no_documents(spark):
    docs = frame(spark, planted(3)[:20])
    got = near_duplicates(docs, carry=["kept_text"] if "kept_text" in docs.columns else ["lang"])
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept", "lang"] and got.count() == 20
    assert near_duplicates(frame(spark, [])).count() == 0


def test_links_connect_what_is_linked():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**60, 60).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(60) < 0.95], rng.integers(0, 2**60, 3).astype(np.uint64)])) for _ in range(40)]
    marks = np.arange(40) % 2
    for across in (None, marks):
        def group(links):
            label = list(range(40))
            for a, b in links:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
            return label

        every = [
            (i, j) for i in range(40) for j in range(i + 1, 40)
            if (across is None or across[i] != across[j])
            and 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))
        ]
        assert group(linked_sets(sets, 85, across)) == group(every) and every


def test_shingles_are_of_words():
    texts = ["A b\tc\nd e", "a b c d e", "a b c d", "a b c d ", "", "a b c d e f", "x a b c d"]
    rng = random.Random(1)
    texts += [" ".join(rng.choices("ab", k=200)), " ".join(rng.choices("abc", k=300))]
    sets = [set(x.tolist()) for x in shingle_sets(pa.array(texts))]
    plain = [plain_shingles(x) for x in texts]
    for i in range(len(texts)):
        for j in range(len(texts)):
            assert len(sets[i] & sets[j]) == len(plain[i] & plain[j])
    assert [len(x) for x in sets] == [len(x) for x in plain]


def test_connected_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(400, k) for k in range(401, 460)]
    pairs += [(k, k + 1) for k in range(500, 560)] + [(7, 7), (None, 3), (3, None)]
    got = dict(map(tuple, components(spark.createDataFrame(pairs, "a long, b long")).collect()))
    label = {x: x for pair in pairs if None not in pair and pair[0] != pair[1] for x in pair}
    for _ in label:
        for a, b in pairs:
            if a in label and b in label and None not in (a, b):
                label[a] = label[b] = min(label[a], label[b])
    assert got == label


# --- benchmark passages ----------------------------------------------------------------------


def plain_distance(item, words):
    """Least edits between the item and any part of the words."""
    before = [0] * (len(words) + 1)
    for i, word in enumerate(item, 1):
        row = [i]
        for j, other in enumerate(words, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (word != other)))
        before = row
    return min(before)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        how = rng.randrange(3)
        if how == 0:
            words[at] = f"new{rng.randrange(10**6)}"
        elif how == 1:
            del words[at]
        else:
            words.insert(at, f"new{rng.randrange(10**6)}")
    return words


def benchmark(rng):
    items = [(k, prose(rng, rng.choice(["en", "fr"]), rng.randint(10, 60))) for k in range(40)]
    return items + [(50, None), (51, ""), (52, "the er on"), (None, prose(rng, "de", 20)), (0, items[0][1])]


def test_passages_within_the_distance_are_found_and_no_others(spark):
    rng = random.Random(6)
    items = benchmark(rng)
    rows = some_documents(9, 40) + odd_documents()
    for k, text in [item for item in items if item[0] is not None and item[0] < 40]:
        words = text.split()
        for share in (0.0, 0.1):
            around = [prose(rng, "de", rng.randint(0, 30)) for _ in range(2)]
            inside = " ".join(edited(rng, words, int(share * len(words))))
            inside = "".join(c.upper() if c.isascii() else c for c in inside)
            rows.append(document(3000 + len(rows), f"{around[0]} {inside} {around[1]}"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(row.doc_id, row.item_id): row for row in contaminated(frame(spark, rows), bench).collect()}
    want = {}
    for row in rows:
        words = words_of(row[1])
        if len(words) > 5000:
            continue
        for item, text in items:
            own = words_of(text)
            if own:
                distance = plain_distance(own, words)
                if distance <= int(EDITS * len(own)):
                    key = (row[0], -1 if item is None else item)
                    want[key] = min(distance, want.get(key, 99))
    long = {row[0] for row in rows if len(words_of(row[1])) > 5000}  # what is found there is checked below
    short = {key for key in got if key[0] not in long}
    assert short <= set(want) and len(short) >= RECALL * len(want) and len(want) >= 80
    assert all(row.item_words == len(words_of(dict(items)[item if item >= 0 else None])) for (_, item), row in got.items())
    exact = {key for key, distance in want.items() if distance == 0}
    assert exact <= set(got) and all(got[key].distance == 0 for key in exact)
    texts = {row[0]: words_of(row[1]) for row in rows}
    by_item = {item: words_of(text) for item, text in items}
    for (doc_id, item), row in got.items():
        part = texts[doc_id][row.first_word : row.first_word + row.n_words]
        assert min(len(part), 1) and plain_distance(by_item[item], part) <= row.distance


def test_several_blocks_of_items(spark, monkeypatch):
    rng = random.Random(6)
    bench = spark.createDataFrame(benchmark(rng), "item_id long, text string")
    rows = [document(k, text) for k, text in benchmark(random.Random(6))]
    want = as_rows(contaminated(frame(spark, rows), bench))
    monkeypatch.setattr(decontamination, "BLOCK_ITEMS", 7)
    assert as_rows(contaminated(frame(spark, rows), bench)) == want
    assert len(want) >= 40


def test_empty_tables(spark):
    bench = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    assert contaminated(frame(spark, []), bench).count() == 0
    assert contaminated(frame(spark, odd_documents()), bench.limit(0)).count() == 0


def test_edit_distance_to_prefixes():
    rng = random.Random(1)
    for _ in range(500):
        item = [rng.randint(1, 4) for _ in range(rng.randint(1, 70))]
        words = [rng.randint(1, 4) for _ in range(rng.randint(0, 80))]
        before = list(range(len(words) + 1))
        for i, word in enumerate(item, 1):
            row = [i]
            for j, other in enumerate(words, 1):
                row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (word != other)))
            before = row
        distance, length = edit_distance(np.array(item, dtype=np.uint64), np.array(words, dtype=np.uint64))
        assert distance == min(before) == before[length]


def index_of(items):
    texts = pa.array([text for _, text in items], pa.string())
    return build_index([(items[row][0], own, keys) for row, own, keys in embed_items(texts)])


def spread_edited(rng, words, edits):
    """Edits at equal distances all over the words."""
    for k in reversed(range(edits)):
        words = cluster_edited(rng, words, 1, int((k + 0.5) * len(words) / edits))
    return words


def at_both_ends(rng, words, edits):
    return cluster_edited(rng, cluster_edited(rng, words, edits // 2, len(words) - edits // 2), edits - edits // 2, 0)


PLACED = {
    "head": lambda rng, words, edits: cluster_edited(rng, words, edits, 0),
    "middle": lambda rng, words, edits: cluster_edited(rng, words, edits, (len(words) - edits) // 2),
    "end": lambda rng, words, edits: cluster_edited(rng, words, edits, len(words) - edits),
    "both ends": at_both_ends,
    "spread": spread_edited,
    "anywhere": lambda rng, words, edits: edited(rng, words, edits),
}


@pytest.mark.parametrize("where", PLACED)
def test_recall_at_the_full_bound(where):
    """Against a finder that misses nothing: passages with as many edits as are allowed, each in a text."""
    rng = random.Random(where)
    items = [(k, prose(rng, "en", 5 + k % 56)) for k in range(224)]
    texts = []
    for _, text in items:
        words = words_of(text)
        inside = " ".join(PLACED[where](rng, words, int(EDITS * len(words))))
        texts.append(f"{prose(rng, 'de', 10)} {inside} {prose(rng, 'de', 10)}")
    want = {hit[:3] for hit in pigeonhole.find_passages(pigeonhole.build_index(items), pa.array(texts))}
    assert {(k, k) for k in range(len(items))} <= {hit[:2] for hit in want}
    got = {hit[:3] for hit in find_passages(index_of(items), pa.array(texts))}
    assert {hit[:2] for hit in got} <= {hit[:2] for hit in want}
    assert len({hit[:2] for hit in got}) >= RECALL * len({hit[:2] for hit in want})
    assert len(got & want) >= 0.97 * len(want)


def test_walks_read_whole_items():
    words = hash_words(pa.array([f"w{k}" for k in range(40)]))
    keys = embed_item(words)
    for walk in walks()[:-2]:
        places = np.sort(keys["place"][keys["walk"] == walk.number])
        # of six steps about three move on; a stretch in which the walk stayed has no key
        assert places[0] < 6 and places[-1] > 25 and np.diff(places).max() <= 12
    # an edit moves walks apart for a while: a copy with another word in the middle is met on both sides of it
    other = words.copy()
    other[20] = 1
    same = np.intersect1d(keys, embed_item(other))
    assert {True, False} == {walks()[number].forward for number in same["walk"].tolist()}
    assert 0 < len(same) < len(keys)
    for size in (1, 2, 3, 4):
        assert (embed_item(words[:size])["place"] == 0).any()


def test_stretches_of_texts_are_those_of_items():
    words = hash_words(pa.array([f"w{k}" for k in range(30)]))
    known, beyond = np.append(words, np.uint64(0)), np.full(6, 30)
    codes = np.concatenate([beyond, np.arange(30), beyond])
    for walk in walks()[:-2]:
        at, key = met_places(walk, codes, known, np.append(np.full(30, True), False), np.arange(6, 36))
        found = dict(zip((at - 6).tolist(), key.tolist()))
        for number, place, value in embed_item(words).tolist():
            if number == walk.number:
                assert found[place if walk.forward else 29 - place] == value


def cluster_edited(rng, words, edits, at):
    """All edits side by side, from the word ``at`` on."""
    for how in rng.choices(["replace", "delete", "insert"], k=edits):
        new = [] if how == "delete" else [f"new{rng.randrange(10**6)}"]
        words = words[:at] + new + words[at + (how != "insert") :]
        at += how != "delete"
    return words


def test_queries_find_short_items(spark, tmp_path, monkeypatch):
    items = [(1, "alpha"), (2, "Beta gamma"), (3, "one two three four five six seven"), (4, "")]
    texts = ["x alpha y", "beta  GAMMA", "x one two three four six seven", "gamma beta", "one two three", "", None]
    rows = [document(k, text) for k, text in enumerate(texts)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(row) for row in op4_edit_decontamination(spark, str(tmp_path)).collect()}
    assert got == {(0, 1, 0, 1, 1, 1), (1, 2, 0, 0, 2, 2), (2, 3, 1, 1, 6, 7)}
    clean = drop_leaks(spark, frame(spark, rows), str(tmp_path))
    assert sorted(row.doc_id for row in clean.collect()) == [3, 4, 5, 6]
    monkeypatch.setattr(corpus_pipeline, "LEAK_WORDS", 2)
    clean = drop_leaks(spark, frame(spark, rows), str(tmp_path))
    assert sorted(row.doc_id for row in clean.collect()) == [0, 3, 4, 5, 6]


def test_short_items_are_found():
    rng, missed = random.Random(12), 0
    items = [(k, " ".join(f"w{k}x{n}" for n in range(k))) for k in range(8)]
    index = index_of(items)
    for item, text in items:
        for edits in {0, int(EDITS * item)}:
            inside = " ".join(edited(rng, text.split(), edits))
            around = [prose(rng, "de", 6) for _ in range(2)]
            hits = {hit[1]: hit for hit in find_passages(index, pa.array([f"{around[0]} {inside} {around[1]}"]))}
            if edits and item not in hits:
                missed += 1
                continue
            assert set(hits) == ({item} if item else set())
            assert not item or hits[item][2] <= edits
            assert not item or edits or hits[item][2:5] == (0, 6, item)
    assert not missed
    # within the bound only
    far = ["w4x0 w4x1 w4x3", "w7x0 w7x1 w7x2 a b w7x5 w7x6", "w3x0 w3x1"]
    assert not list(find_passages(index, pa.array(far)))


# --- nearest neighbours ----------------------------------------------------------------------


def vectors(seed, count, dim=32):
    rng = np.random.default_rng(seed)
    rows = [(k, [float(x) for x in rng.normal(size=dim).astype(np.float32)], 1) for k in range(count)]
    rows += [(count + k, rows[50][1], 2) for k in range(60)]  # many copies of a query
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, k=5):
    ids = np.array([row[0] for row in rows])
    matrix = np.array([row[1] for row in rows], dtype=np.float64)
    units = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    out = {}
    for q in np.flatnonzero(ids % 50 == 0):
        score = (units @ units[q]).round(12)
        order = [x for x in np.lexsort((ids, -score)) if ids[x] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[x]), score[x]) for x in order]
    return out


def test_recall_and_exact_scores(spark):
    rows = vectors(1, 3000)
    nan, inf = float("nan"), float("inf")
    odd = [(5000, None, 0), (5050, [0.0] * 32, 0), (5100, [nan] * 32, 0), (5150, [inf] * 32, 0),
           (5200, [None] * 32, 0), (5250, [1.0] * 3, 0), (None, [1.0] * 32, 0), rows[0], rows[50]]
    got = nearest(spark.createDataFrame(rows + odd, SCHEMA)).collect()
    want = brute_force(rows)
    found = defaultdict(list)
    for row in sorted(got, key=lambda row: (row.query_id, row["rank"])):
        found[row.query_id].append((row.vec_id, row.score))
    assert set(found) == set(want)
    assert all(len(own) == 5 for own in found.values())
    hits = sum(len({x for x, _ in found[q]} & {x for x, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    units = {row[0]: np.array(row[1], dtype=np.float64) / np.linalg.norm(np.array(row[1], dtype=np.float64)) for row in rows}
    for q, own in found.items():
        assert own == sorted(own, key=lambda x: (-x[1], x[0])) and q not in {x for x, _ in own}
        for x, score in own:
            assert score == pytest.approx(float(units[q] @ units[x]), abs=1e-9)
    # copies of a query: the smallest ids first
    assert [x for x, _ in found[50]] == [3000, 3001, 3002, 3003, 3004]
    assert [x for x, _ in found[3000]] == [50, 3001, 3002, 3003, 3004]


def test_few_vectors(spark):
    assert nearest(spark.createDataFrame([], SCHEMA)).count() == 0
    assert nearest(spark.createDataFrame([(0, [1.0, 2.0], 1)], SCHEMA)).count() == 0
    rows = [(0, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [-1.0, 0.1], 1)]
    got = nearest(spark.createDataFrame(rows, SCHEMA)).sort("rank").collect()
    assert [(row["rank"], row.vec_id) for row in got] == [(1, 1), (2, 2)]


def test_every_length_is_searched(spark):
    rows, rare = vectors(3, 400), [(k + 10_000, own, x) for k, own, x in vectors(4, 120, dim=6)]
    got = nearest(spark.createDataFrame(rows + rare + [(20_000, [1.0], 0)], SCHEMA)).collect()
    want = brute_force(rows) | brute_force(rare)
    assert {row.query_id for row in got} == set(want) and 10_100 in want
    assert Counter(row.query_id for row in got) == Counter({q: 5 for q in want})
    hits = sum(row.vec_id in {x for x, _ in want[row.query_id]} for row in got)
    assert hits >= 0.9 * len(got)


def test_queries_short_of_rows_are_compared_with_all(spark, monkeypatch):
    rows = vectors(2, 300)
    monkeypatch.setattr(multi_index, "learn_codes", lambda sample, k: multi_index.Codes(learn_codes(sample, k).rotations, 0))
    got = nearest(spark.createDataFrame(rows, SCHEMA)).collect()
    want = brute_force(rows)
    assert {(row.query_id, row.vec_id) for row in got} == {(q, x) for q, own in want.items() for x, _ in own}


@pytest.mark.parametrize("radius", [0, 3, 7, 16, 40])
def test_probing_retrieves_every_code_within_the_radius(radius):
    rng = np.random.default_rng(radius)
    packed = rng.integers(0, 256, (500, 16), dtype=np.uint8)
    packed[:100] = packed[0] ^ (rng.random((100, 16)) < 0.1)
    index = SubstringIndex(packed)
    for code in packed[:20]:
        want = np.flatnonzero(np.bitwise_count(packed ^ code).sum(axis=1) <= radius)
        assert index.within(code, radius).tolist() == want.tolist()


def share_met(vectors):
    codes = learn_codes(vectors, 5)
    packed = codes.encode(vectors)
    index = SubstringIndex(packed)
    asked = range(0, len(vectors), 50)
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    met = hits = 0
    for query in asked:
        rows = index.probe(packed[query], codes.radius)
        met += len(rows)
        likeness = units @ units[query]
        likeness[query] = -2
        best = np.argsort(-likeness)[:5]
        hits += np.isin(best, index.within(packed[query], codes.radius)).sum()
    return met / (len(asked) * len(vectors)), hits / (5 * len(asked))


def test_few_rows_are_met_where_vectors_lie_in_clusters():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(400, 64))
    clustered = np.repeat(centres, 10, axis=0) + 0.15 * rng.normal(size=(4000, 64))
    share, recall = share_met(clustered)
    assert share < 0.1 and recall >= 0.95
    # among random vectors the nearest is hardly nearer than others, and probing meets nearly all rows
    share, recall = share_met(rng.normal(size=(4000, 64)))
    assert share > 0.9 and recall >= 0.95
