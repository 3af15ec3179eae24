"""Parts of the benchmark bound memory only: leaks and scores are those of one index over all items."""

import collections
import math
import random

from kinlink.llm import decontaminate


def test_scores_do_not_depend_on_the_parts(spark):
    items = [(i, f"What is the {w} of thing number {i * 7} in the {w} list? Answer: it is the {w} {i} itself") for i, w in enumerate("red red red blue green red".split())]
    items += [(6, "one long item " + " ".join(f"x{k}" for k in range(60)) + " Answer: red thing")]
    texts = [t for _, t in items] + [items[1][1].replace("thing number", "object"), "filler " * 9 + items[3][1].replace("itself", "too")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    one, split = ({(r.doc_id, r.item_id): r.score for r in decontaminate.find_leaks(docs, bench, threshold=0.3, part=p).collect()} for p in (100, 2))
    assert one and set(one) == set(split)
    assert all(abs(one[k] - split[k]) < 1e-9 for k in one)


def brute_leaks(items, texts, threshold):
    """BM25 of every passage against every item, then both shares, all by hand."""
    words = {i: decontaminate.words_of(t) for i, t in items}
    n, mean = len(items), sum(map(len, words.values())) / len(items)
    held = collections.Counter(w for own in words.values() for w in set(own))
    s = max(map(len, words.values()))

    def impact(own, w):
        tf = own.count(w)
        idf = math.log(1 + (n - held[w] + 0.5) / (held[w] + 0.5))
        return idf * tf * (decontaminate.K1 + 1) / (tf + decontaminate.K1 * (1 - decontaminate.B + decontaminate.B * len(own) / mean))

    found = {}
    for d, text in texts:
        own = decontaminate.words_of(text)
        for at in range(0, max(1, len(own)), s):
            if at and at + s >= len(own):
                continue
            passage = own[at : at + 2 * s]
            for i, t in items:
                score = sum(impact(words[i], w) for w in set(words[i]) & set(passage)) / sum(impact(words[i], w) for w in set(words[i]))
                question, answer = decontaminate.question_and_answer(t)
                k = min(5, len(question))
                grams = {tuple(question[j : j + k]) for j in range(len(question) - k + 1)}
                there = {tuple(passage[j : j + k]) for j in range(len(passage) - k + 1)}
                pairs = set(zip(passage, passage[1:], strict=False))
                covered = [False] * len(answer)
                for j in range(len(answer) - 1):
                    if (answer[j], answer[j + 1]) in pairs:
                        covered[j] = covered[j + 1] = True
                if score >= threshold and 2 * len(grams & there) >= len(grams) and 2 * sum(covered) >= len(answer):
                    found[d, i] = max(found.get((d, i), 0), score)
    return found


def edited(r, text, share):
    return " ".join(w if r.random() > share else "changed" for w in text.split())


def test_leaks_by_hand(spark):
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdef") for _ in range(r.randint(2, 5)))
    common = [word() for _ in range(12)]
    sentence = lambda n: " ".join(r.choice(common) if r.random() < 0.5 else word() for _ in range(n))
    items = [(f"item-{i}", f"{sentence(r.randint(8, 25))}? Answer: {sentence(r.randint(2, 8))}") for i in range(25)]
    texts = []
    for d in range(150):
        parts = [sentence(r.randint(0, 80))]
        for _ in range(r.randint(0, 2)):
            parts += [edited(r, r.choice(items)[1], r.choice([0, 0.1, 0.2, 0.35])), sentence(r.randint(0, 60))]
        texts.append((d, " ".join(parts)))
    want = brute_leaks(items, texts, 0.6)
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    assert 20 < len(want)
    for part in (20_000, 7, 1):
        found = {(x.doc_id, x.item_id): x.score for x in decontaminate.find_leaks(docs, bench, part=part).collect()}
        assert set(found) == set(want) and all(abs(found[k] - want[k]) < 1e-9 for k in want)
    clean = {x.doc_id for x in decontaminate.without_leaks(docs, bench).collect()}
    assert clean == {d for d, _ in texts} - {d for d, _ in want}
