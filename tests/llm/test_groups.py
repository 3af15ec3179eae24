import collections
import random
import re
import zlib

import numpy as np
import pytest

from kinlink.llm import ann, chat, decontaminate, neardup, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_components(rows, width, percent):
    sets = {}
    for i, text in rows:
        w = WORD.findall((text or "").translate(LOW))
        k = min(width, len(w))
        sets[i] = frozenset(zip(*[w[j:] for j in range(k)], strict=False)) if k else frozenset()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(n, seed, words=80, vocabulary=5000):
    r = random.Random(seed)
    base = [f"v{r.randint(0, vocabulary)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randint(0, 9)):
            w[r.randrange(words)] = f"n{r.randint(0, 10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("width, rounds", [(2, 2), (5, 3), (2, 1)])
def test_near_duplicates(spark, width, rounds):
    r = random.Random(width)
    texts = near_copies(90, 1) + near_copies(25, 2) + near_copies(8, 3, 12)
    texts += [" ".join(f"w{r.randint(0, 3000)}" for _ in range(60)) for _ in range(60)]
    texts += ["Same Text here"] * 40 + ["same  text\there", "one", "One", "", None, " \n ", "a b", "A\x0bB", "x " * 5000]
    rows = list(enumerate(texts))
    r.shuffle(rows)
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows] + [(3, texts[3], 1)], "doc_id long, text string, component_id int")
    found = neardup.near_duplicates(docs, width=width, percent=80, rounds=rounds).collect()
    want = brute_components(rows, width, 80)
    assert len(found) == len(rows) + 1
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in found} == want
    assert all(x.kept == (x.doc_id == x.component_id) for x in found)


@pytest.mark.parametrize("percent", [80, 50])
def test_many_copies_that_are_unlike_each_other(spark, percent):
    """Edited copies of one text, most of them below the threshold to each other, with families and no original."""
    r = random.Random(11)
    base = [f"v{k}" for k in range(100)]
    texts = []
    for n in range(2000):
        w = list(base)
        for _ in range(r.randint(3, 13) * (3 if percent == 50 else 1)):
            at = r.randrange(len(w))
            w[at : at + 1] = [[f"n{r.randint(0, 10**6)}"], [], [w[at], f"m{r.randint(0, 30)}"]][r.randint(0, 2)]
        if n % 5 == 0 and texts:  # a family of its own
            w = r.choice(texts).split()
            w[r.randrange(len(w))] = "f"
        texts.append(" ".join(w))
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    found = {x.doc_id: x.component_id for x in neardup.near_duplicates(docs, width=2, percent=percent).collect()}
    names = {}
    table = np.zeros((len(rows), 40_000), np.float32)
    for i, t in rows:
        w = t.split()
        for pair in zip(w, w[1:], strict=False):
            table[i, names.setdefault(pair, len(names))] = 1
    size, both = table.sum(1), table @ table.T
    linked = 100 * both >= percent * (size[:, None] + size - both)
    label = np.arange(len(rows))
    while (label != (new := np.where(linked, label, len(rows)).min(1))).any():
        label = new
    assert found == dict(enumerate(label.tolist()))
    assert 100 < len(set(found.values())) < 1900


def test_texts_of_one_id_are_one_document(spark):
    one, two, three = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    rows = [(1, one), (5, one), (5, two), (7, two), (5, one), (9, three), (9, ""), (8, three), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((x.doc_id, x.component_id, x.kept) for x in neardup.near_duplicates(docs).collect())
    assert found == sorted([(1, 1, True)] + [(5, 1, False)] * 3 + [(7, 1, False), (8, 8, True), (9, 8, False), (9, 9, True), (2, 2, True)])


def test_near_duplicates_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert neardup.near_duplicates(empty).count() == 0
    nulls = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (4, None)], "doc_id long, text string")
    assert all(x.kept for x in neardup.near_duplicates(nulls).collect())


def test_bayesian_bounds_miss_few():
    """Pairs at the threshold pass; far ones mostly do not."""
    bounds = neardup.least_matches(0.8, 1e-6)
    r = np.random.default_rng(0)
    n = np.arange(1, neardup.BATCHES + 1) * neardup.BATCH
    passed = lambda j: np.mean([(np.cumsum(r.random(n[-1]) < (1 + j) / 2)[n - 1] >= bounds).all() for _ in range(3000)])
    assert passed(0.8) > 0.999 and passed(0.4) < 0.001


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    found = {r.node: r.label for r in neardup.components(edges).collect()}
    assert found == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def check_shards(rows, found, n_shards, share):
    assert len(found) == len(rows)
    sizes, slots, groups = collections.Counter(), collections.defaultdict(list), collections.defaultdict(set)
    size = lambda t: len((t or "").encode()) + 8
    texts = dict(rows)
    for r in found:
        text = texts[r.doc_id] or ""
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (size(text), zlib.crc32(text.encode()), "bytes", None)
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
        groups[text].add(r.shard)
    total = sum(sizes.values())
    target = total / n_shards
    largest = max(size(t) for t in texts.values())
    assert all(abs(sizes[s] - target) <= share * target + 2 * largest for s in range(n_shards))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    weight = collections.Counter(t or "" for t in texts.values())
    for text, shards in groups.items():
        assert sorted(shards) == list(range(min(shards), max(shards) + 1))
        assert len(shards) == 1 or weight[text] * size(text) > share * target


def test_shards(spark):
    r = random.Random(1)
    texts = ["a hot text " * 5] * 700 + [None, "", ""] + ["é" * r.randint(0, 200) + str(i) for i in range(1400)]
    rows = list(enumerate(texts))
    r.shuffle(rows)
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, shard int").repartition(7)
    check_shards(rows, sharding.shard_by_bytes(docs).collect(), 24, 0.05)
    again = sharding.shard_by_bytes(docs.repartition(3)).collect()
    assert sorted(again) == sorted(sharding.shard_by_bytes(docs).collect())


def test_shards_of_little(spark):
    docs = spark.createDataFrame([(5, "x"), (None, None), (5, "x")], "doc_id long, text string")
    found = sharding.shard_by_bytes(docs, n_shards=2).collect()
    assert len(found) == 3 and {f.shard for f in found} <= {0, 1}
    assert sharding.shard_by_bytes(docs.limit(0)).count() == 0


def brute_chat(rows):
    convs = collections.defaultdict(set)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].add((turn is not None, turn or 0, role or "unknown", text or ""))
    chains = {c: tuple((x[2], x[3]) for x in sorted(v)) for c, v in convs.items()}
    kept = {}
    for c in sorted(chains):
        mine = chains[c]
        if not any(len(o) > len(mine) and o[: len(mine)] == mine for o in chains.values()):
            kept.setdefault(mine, []).append(c)
    return {v[0]: (len(k), len(v), "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in k)) for k, v in kept.items()}


@pytest.mark.parametrize("chunk", [256, 2])
def test_chat(spark, chunk):
    r = random.Random(4)
    rows = []
    for c in range(40):
        talk = [("user" if k % 2 == 0 else "assistant", f"t{r.randint(0, 2)}") for k in range(r.randint(1, 7))]
        rows += [(c, k, *x) for k, x in enumerate(talk)]
        rows += [(100 + c, 10 + k, *x) for k, x in enumerate(talk[: r.randint(1, len(talk))])]  # a snapshot, numbered otherwise
    rows += [(300, 0, None, None), (300, 0, None, None), (301, None, "user", "x"), (None, 0, "user", "x")]
    rows += [(400, 0, "user", "t"), (400, 1, "a", "b:c"), (401, 0, "user", "t"), (401, 1, "ab", ":c")]
    docs = spark.createDataFrame([(*x, "e") for x in rows], "conv_id long, turn long, role string, text string, part string")
    want = brute_chat(rows)
    found = collections.defaultdict(list)
    for x in chat.render_conversations(docs, chunk).collect():
        found[x.conv_id].append((x.part, x.n_turns, x.copies, x.text))
    assert set(found) == set(want)
    for c, parts in found.items():
        parts.sort()
        assert (parts[0][1], parts[0][2], "".join(p[3] for p in parts)) == want[c]
    assert chat.render_conversations(docs.limit(0)).count() == 0


def brute_nearest(rows, k, every):
    ids = np.array([i for i, _ in rows])
    v = np.array([x for _, x in rows], np.float64)
    out = {}
    for n in np.flatnonzero(ids % every == 0):
        s = (v * v[n]).sum(1)
        out[int(ids[n])] = [(int(ids[j]), s[j]) for j in np.lexsort((ids, -s)) if j != n][:k]
    return out


def test_nearest(spark):
    r = np.random.default_rng(1)
    centres = r.normal(size=(10, 32))
    v = (centres[r.integers(0, 10, 1500)] + r.normal(size=(1500, 32))).astype(np.float32)
    v[200:700] = v[200]  # a vector that a third of all rows repeat
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    bad = [(2000, None), (2020, [0.0] * 32), (2040, [float("nan")] * 32), (2060, [None] * 32), (None, rows[0][1]), (2080, [1.0])]
    table = spark.createDataFrame([(*x, 1) for x in rows + bad + rows[:5]], "vec_id long, embedding array<float>, rank int")
    found = collections.defaultdict(list)
    for x in ann.nearest(table, k=20).collect():
        found[x.query_id].append((x.rank, x.vec_id, x.score))
    want = brute_nearest(rows, 20, 20)
    assert set(found) == set(want)
    hits = 0
    for q, best in found.items():
        best.sort()
        assert [b[0] for b in best] == list(range(1, 21))
        assert all(abs(s - float((v[q].astype(float) * v[i]).sum())) < 1e-9 for _, i, s in best)
        hits += len({b[1] for b in best} & {w[0] for w in want[q]})
    assert hits / (20 * len(want)) >= 0.99
    assert [(b[1]) for b in found[400]] == [w[0] for w in want[400]]  # ties by id


def test_codes_leave_little_to_rerank():
    """The share of vectors that the bounds leave for the exact product, and what they lose."""
    r = np.random.default_rng(5)
    v = r.normal(size=(20_000, 64))
    v /= np.linalg.norm(v, axis=1)[:, None]
    turn, centre = ann.rotation(64, 512), v[:4096].mean(0)
    packed, far, fit, with_centre = ann.encode(v, centre, turn)
    q = v[:200]
    estimate, error = ann.bounds(q, ann.signs_of(packed, 512), far, fit, with_centre, centre, turn, 2.5)
    exact = q @ v.T
    assert (np.abs(estimate - exact) <= error).mean() > 0.97
    floor = -np.sort(-(q @ v[:16_384].T), axis=1)[:, 20]
    maybe = estimate + error >= floor[:, None]
    kth = -np.sort(-exact, axis=1)[:, 20]
    assert maybe.mean() < 0.05 and maybe[exact >= kth[:, None]].mean() > 0.99


def test_lists_are_full(spark):
    r = np.random.default_rng(9)
    rows = [(i, r.normal(size=16).tolist()) for i in range(600)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for width, sample in ((0.0, 600), (0.0, 5), (2.5, 300)):
        found = collections.Counter(x.query_id for x in ann.nearest(table, k=20, width=width, sample=sample).collect())
        assert found == {i: 20 for i in range(0, 600, 20)}


def test_ids_with_several_vectors(spark):
    r = np.random.default_rng(3)
    rows = [(int(i), r.normal(size=8).round(3).tolist()) for i in r.integers(0, 60, 400)]
    rows += [(0, rows[5][1]), (7, rows[5][1]), (7, rows[5][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = {}
    for q in (0, 20, 40):
        own = [np.array(v) for i, v in rows if i == q]
        score = {}
        for i, v in rows:
            if i != q:
                score[i] = max([score.get(i, -np.inf), *(float((np.array(v) * x).sum()) for x in own)])
        want[q] = [i for i, _ in sorted(score.items(), key=lambda x: (-x[1], x[0]))][:20]
    found = collections.defaultdict(list)
    for x in sorted(ann.nearest(table, k=20, sample=100).collect()):
        found[x.query_id].append(x.vec_id)
    assert found == want


def test_nearest_of_few(spark):
    table = spark.createDataFrame([(0, [1.0, 2.0]), (7, [2.0, 1.0])], "vec_id long, embedding array<double>")
    assert [tuple(x) for x in ann.nearest(table, k=20).collect()] == [(0, 1, 7, 4.0)]
    assert ann.nearest(table.limit(0), k=20).count() == 0


def benchmark_items(r, n=40):
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6)))
    common = [word() for _ in range(15)]
    return [(i, " ".join(r.choice(common) if r.random() < 0.4 else word() for _ in range(r.randint(12, 50))) + ".") for i in range(n)], common, word


def test_wand_retrieves_all_above_the_threshold():
    r = random.Random(6)
    items, common, word = benchmark_items(r, 120)
    index = decontaminate.Index(items, 0.3, 0, 0)
    for _ in range(200):
        held = r.sample(items, r.randint(0, 3))
        words = [w for _, t in held for w in decontaminate.words_of(t) if r.random() < r.random()]
        terms = sorted({index.vocabulary[w] for w in words if w in index.vocabulary})
        scores = collections.Counter()
        for t in terms:
            for n, x in zip(*index.postings[t], strict=True):
                scores[n] += x
        want = {n: s for n, s in scores.items() if s >= 0.3 - 1e-9}
        found = dict(index.retrieve(terms))
        assert set(found) == set(want) and all(abs(found[n] - want[n]) < 1e-9 for n in want)


def test_leaks(spark):
    r = random.Random(8)
    items, common, word = benchmark_items(r)
    noise = lambda n: " ".join(r.choice(common) if r.random() < 0.3 else word() + word() for _ in range(n))
    docs, want = [], set()
    for d in range(120):
        text = noise(r.randint(5, 300))
        if d % 3 == 0:
            i, item = r.choice(items)
            text += "\n" + item.upper() + " " + noise(r.randint(0, 200))
            want.add((d, i))
        if d % 10 == 1:  # the first words of an item only: its question, not its answer
            text += " " + " ".join(items[0][1].split()[:4])
        docs.append((d, text, "s"))
    docs += [(500, None, "s"), (501, "", "s"), (None, items[1][1], "s"), (0, docs[0][1], "s")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, score string")
    bench = spark.createDataFrame(items + [(None, "x y"), (99, None), (98, " ")], "item_id long, text string")
    for part in (20_000, 7):
        found = [(x.doc_id, x.item_id) for x in decontaminate.find_leaks(frame, bench, part=part).collect()]
        assert sorted(x for x in found if x[0] is not None) == sorted([*want, *(w for w in want if w[0] == 0)])
        assert [x for x in found if x[0] is None] == [(None, 1)]
    clean = decontaminate.without_leaks(frame, bench)
    assert {x.doc_id for x in clean.collect()} == {d for d, _, _ in docs if d is not None} - {d for d, _ in want}
    assert clean.columns == frame.columns
    assert decontaminate.find_leaks(frame, bench.limit(0)).count() == 0
