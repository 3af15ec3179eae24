import collections
import random
import re
import tracemalloc
import zlib

import numpy as np
import pytest

from kinlink.llm import langid, licenses, toxicity

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
VOICES = {
    "en": "the and of that with was from this have not are but which their would there".split(),
    "de": "der die und das nicht mit sich auch auf eine werden über für können müssen".split(),
    "fr": "le la les des est dans une pour qui sur pas avec plus être cette même où".split(),
}


def sentences(lang, n, seed=0):
    r = random.Random(f"{lang}{seed}")
    return [" ".join(r.choice(VOICES[lang]) for _ in range(r.randint(5, 40))) for _ in range(n)]


def labelled(spark, n=60):
    rows = [(lang, text) for lang in VOICES for text in sentences(lang, n)]
    rows = [(i, text, lang, "score") for i, (lang, text) in enumerate(rows)]
    rows += [(900, None, "en", "s"), (901, "", "en", "s"), (902, "123 !!", "en", "s"), (903, sentences("de", 1, 9)[0], None, "s"), (None, "the and of that", "fr", "s")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")


def plain_grams(text):
    """N-grams by hand: letters in lower case, one border between words and at both ends."""
    flat = re.sub("\0+", "\0", "\0" + "".join(c.lower()[0] if c.isalpha() else "\0" for c in text) + "\0")
    found = collections.Counter()
    for n in (1, 2, 3):
        found.update(flat[k : k + n] for k in range(len(flat) - n + 1))
    del found["\0"]
    return found if any(x.strip("\0") for x in found) else {}


def brute_profile(texts, top):
    total = sum((collections.Counter(plain_grams(t)) for t in texts), collections.Counter())
    return sorted(total, key=lambda g: (-total[g], len(g), g))[:top]


def brute_distance(text, profile, top):
    own = brute_profile([text], top)
    ranks = {g: k for k, g in enumerate(profile)}
    return sum(abs(ranks[g] - k) if g in ranks else top for k, g in enumerate(own))


def spelled(gram):
    n = 3 if gram >= langid.TRIPLES else 2 if gram >= langid.PAIRS else 1
    return "".join(chr(gram >> k * langid.BITS & (1 << langid.BITS) - 1) for k in range(n - 1, -1, -1))


def test_profiles_and_distances_by_hand(spark):
    docs = labelled(spark)
    profiles = langid.learn_profiles(docs)
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    for lang, grams in profiles.items():
        texts = [r.text or "" for r in docs.collect() if r.lang == lang and r.doc_id is not None and not held(r.doc_id)]
        assert [spelled(g) for g in grams] == brute_profile(texts, 400)
    speaker = langid.Identifier(profiles, 400)
    plain = {lang: [spelled(g) for g in p] for lang, p in profiles.items()}
    for text in [*sentences("fr", 5, 3), "über", "x", "ДА нет і ї й", "日本 語", "ǅ İ"]:
        apart = {lang: brute_distance(text, p, 400) for lang, p in plain.items()}
        lang, score = speaker.predict(text)
        n = min(400, len(plain_grams(text)))
        assert lang == min(sorted(apart), key=apart.get) and abs(score - (1 - apart[lang] / (400 * n))) < 1e-12


def test_letters_of_other_scripts_differ(spark):
    rows = [(k, t, lang) for lang, t in (("uk", "і ї ґ є"), ("sr", "ј љ њ џ")) for k in range(40)]
    docs = spark.createDataFrame([(n, t, lang) for n, (_, t, lang) in enumerate(rows)], "doc_id long, text string, lang string")
    profiles = langid.learn_profiles(docs)
    assert not {g for g in profiles["uk"] if len(spelled(g).strip("\0"))} & {g for g in profiles["sr"] if len(spelled(g).strip("\0"))}


def test_languages(spark):
    docs = labelled(spark)
    profiles = langid.learn_profiles(docs)
    assert set(profiles) == set(VOICES)
    found = {r.doc_id: r for r in langid.identify_languages(docs, profiles).collect()}
    assert len(found) == docs.count()
    held = [r for r in docs.collect() if r.doc_id is not None and r.doc_id < 900 and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert held and np.mean([found[r.doc_id].lang_pred == r.lang for r in held]) >= 0.95
    assert all(found[r.doc_id].held_out for r in held)
    assert all((found[i].lang_pred, found[i].score) == ("und", 0.0) for i in (900, 901, 902))
    assert found[903].lang_pred == "de" and found[None].lang_pred == "en" and not found[None].held_out


def test_held_out_rows_teach_nothing(spark):
    docs = labelled(spark).where("doc_id IS NOT NULL")
    other = docs.collect()
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    changed = [(r.doc_id, r.text, "xx" if held(r.doc_id) else r.lang) for r in other]
    changed = spark.createDataFrame(changed, "doc_id long, text string, lang string")
    assert langid.learn_profiles(changed) == langid.learn_profiles(docs)


def test_nothing_learnt(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert langid.learn_profiles(docs) == {}
    assert langid.identify_languages(docs, {}).head().lang_pred == "und"
    assert langid.identify_languages(docs.limit(0), {}).count() == 0


def test_blocks_of_long_texts(monkeypatch):
    text = " ".join(sentences("de", 30)) + "\n\n 12 " + " ".join(sentences("en", 30))
    grams, counts = langid.gram_counts(text)
    monkeypatch.setattr(langid, "BLOCK", 97)
    again, more = langid.gram_counts(text)
    assert (grams == again).all() and abs(counts - more).sum() <= 2


def toxic_corpus(n=400):
    r = random.Random(7)
    rows = []
    for i in range(n):
        words = [f"w{r.randint(0, 400)}" for _ in range(60)]
        bad = i % 4 == 0
        if bad:
            words[r.randint(0, 59)] = r.choice(["idiot", "scum", "Loser!"])
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_toxicity(spark):
    rows = toxic_corpus()
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(1000, None, "x"), (1001, "", "x"), (None, "idiot", "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(None, 1, 1), (1000, 1, None)], "doc_id long, quality int, toxic int")
    machine = toxicity.learn(docs, labels)
    found = {r.doc_id: r for r in toxicity.score_toxicity(docs, machine).collect()}
    held = [(i, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(found[i].held_out for i, _ in held)
    assert np.mean([found[i].predicted == y for i, y in held]) >= 0.97
    assert found[1000].score == found[1001].score < 0.5 and found[None].predicted == 1
    flipped = spark.createDataFrame([(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, _, y in rows], "doc_id long, toxic int")
    again = toxicity.learn(docs, flipped)
    assert again.bias == machine.bias and (again.weights == machine.weights).all()


def test_scores_by_hand(spark):
    """Every score against the machine's formula, written out over pairs."""
    rows = toxic_corpus(200)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(500, None), (501, "?")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    machine = toxicity.learn(docs, labels, steps=60)
    number = {int(p): k for k, p in enumerate(machine.places)}
    for r in docs.join(toxicity.score_toxicity(docs, machine), "doc_id").collect():
        words = set(re.findall(rb"[0-9a-z\x80-\xff]+", (r.text or "").lower().encode()))
        places = {zlib.crc32(b"w" + w) % 2**20 for w in words} | {zlib.crc32(b"%d" % n + w[:n]) % 2**20 for w in words for n in (4, 5) if len(w) > n}
        terms = sorted(number[p] for p in places if p in number)
        logit = machine.bias + sum(machine.weights[t] for t in terms)
        logit += sum(float(machine.factors[a] @ machine.factors[b]) for n, a in enumerate(terms) for b in terms[n + 1 :])
        assert abs(r.score - 1 / (1 + np.exp(-logit))) < 1e-9


def test_learning_is_bounded(spark):
    """A repeated id teaches once; texts beyond the number of places do not teach."""
    rows = toxic_corpus(100)
    once = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    again = once.unionByName(once.where("doc_id < 9"))
    one, two = (toxicity.learn(d, labels, steps=30) for d in (once, again))
    assert (one.places == two.places).all() and (one.weights == two.weights).all()
    assert len(toxicity.learn(once, labels, most_places=2000, steps=30).places) < len(one.places)


def test_learning_holds_few_arrays_over_all_terms(spark):
    r = random.Random(3)
    n = 3000
    words = [" ".join(f"{r.randrange(10**6):06d}" for _ in range(500)) for _ in range(n)]
    docs = spark.createDataFrame([(i, "bad " * (i % 2) + w) for i, w in enumerate(words)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(n)], "doc_id long, toxic int")
    tracemalloc.start()
    try:
        machine = toxicity.learn(docs, labels, steps=10, epochs=1)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(machine.places) and peak < 100e6  # 3.5 million terms in all


def test_pairs_weigh_more_than_their_parts(spark):
    """Two words that are harmless alone, toxic together: no linear weights can say so."""
    r = random.Random(3)
    rows = []
    for i in range(1200):
        a, b = r.random() < 0.5, r.random() < 0.5
        rows.append((i, " ".join([f"w{r.randint(0, 50)}" for _ in range(8)] + ["alpha"] * a + ["beta"] * b), int(a and b)))
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    machine = toxicity.learn(docs, labels, epochs=30)
    terms = toxicity.Terms(machine.places)
    get = lambda *w: machine.logit(np.array(sorted({k for x in w for k in terms[x]}), np.int64))
    assert get(b"alpha", b"beta") > 0 > max(get(b"alpha"), get(b"beta"))


@pytest.mark.parametrize("labels, score", [([], 0.0), ([(1, 0)], 0.0), ([(1, 1)], 1.0)])
def test_one_class_or_none(spark, labels, score):
    docs = spark.createDataFrame([(1, "a text"), (2, "other")], "doc_id long, text string")
    machine = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert all(abs(r.score - score) < 1e-6 for r in toxicity.score_toxicity(docs, machine).collect())
    assert toxicity.score_toxicity(docs.limit(0), machine).count() == 0


def brute_base(text):
    words = WORDS.findall((text or "").translate(LOW))
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        k = phrase.split()
        for i in range(len(words) - len(k) + 1):
            if words[i : i + len(k)] == k:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_licenses(spark):
    r = random.Random(2)
    bits = ["MIT License", "mit\nlicense", "apache-license", "GNU General Public License", "general", "public", "license", "mit", "emit license", "mit licenses", "é", "x", "the apache licence", "mit license mit license"]
    texts = [None, "", "  ", "MIT LICENSE" * 3, "mit license " * 500]
    texts += [" ".join(r.choice(bits) for _ in range(r.randint(1, 14))) for _ in range(300)]
    docs = spark.createDataFrame([(i, x, "l") for i, x in enumerate(texts)] + [(3, texts[3], "l")], "doc_id long, text string, labels string")
    for row in licenses.scan_licenses(docs).collect():
        assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == brute_base(texts[row.doc_id])
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(",")) and 0 <= row.score <= 1
    assert licenses.scan_licenses(docs.limit(0)).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_labels_by_hand():
    """Every run of words against every pattern."""
    notices = [("gnu lesser general public license", "lgpl", 3), ("all rights reserved", "own", 1), ("mozilla public license", "mpl", 2)]
    scanner = licenses.Scanner(licenses.BASE, notices)
    patterns = [(p, label, 1) for p, label in licenses.BASE.items()] + notices
    r = random.Random(4)
    bits = "mit license licence licens gnu lesser general genral public pubic mozila mozilla all rights right reserved x kit".split()
    for _ in range(400):
        words = [r.choice(bits) for _ in range(r.randint(1, 9))]
        want = set()
        for p, label, k in patterns:
            names = {w for w in p.split() if w in ("mit", "gnu")}
            for i in range(len(words)):
                for j in range(i + 1, len(words) + 1):
                    if names <= set(words[i:j]) and distance(" ".join(words[i:j]), p) <= k:
                        want.add(label)
        assert scanner.scan(" ".join(words))["labels"] == ",".join(sorted(want)), words


@pytest.mark.parametrize("text", ["the speed limit license was granted", "we submit license forms", "omit license fees", "kit license", "a bit license", "hit license plate"])
def test_parts_of_words_are_no_notice(text):
    assert licenses.Scanner(licenses.BASE, licenses.NOTICES).scan(text)["labels"] == ""


def test_fuzzy_notices():
    scanner = licenses.Scanner(licenses.BASE, licenses.NOTICES)
    found = scanner.scan("x y Permision is hereby granted, free off charge, to any person obtaining a cpy z")
    assert found["labels"] == "mit" and found["n_base"] == 0 and 0.9 < found["score"] < 1
    assert [(s["label"], s["first_word"], s["edits"]) for s in found["spans"]] == [("mit", 2, 3)]
    assert scanner.scan("the apache licence")["labels"] == "apache"
    assert scanner.scan("nothing of that kind")["spans"] == []
