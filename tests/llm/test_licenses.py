"""Stretches of merged diagonals, against all stretches of short texts."""

import random

from millrace.llm import licenses


def labels(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return {r.doc_id: (r.labels, round(r.score, 9)) for r in licenses.license_labels(df, **options).collect()}


def test_a_longer_text_keeps_what_a_shorter_one_has(spark):
    short = "Licensed under CC BY 4.0."
    long = "licensed under cc by 4 0" + " by 4 0" * 4
    gpl = next(t for x, t in licenses.TEMPLATES if x == "gpl-3" and t.startswith("GNU"))
    got = labels(spark, [short, long, "by 4 0 " * 30 + long + " by 4 0" * 300, gpl, None])
    assert all(got[i] == ("cc-by", 1.0) for i in range(3)) and got[3] == ("gpl-3", 1.0) and got[4] == ("", 0.0)


def held(words, template, size):
    """The best share of the template's runs of words in any stretch of the length allowed that stands on linked diagonals."""
    k = min(len(template), size)
    grams = len(template) - k + 1
    hits = [(p, t) for p in range(len(words) - k + 1) for t in range(grams) if words[p : p + k] == template[t : t + k]]
    allowed = int(licenses.STRETCH * len(template) + licenses.SLACK)
    runs, last = [], None
    for d in sorted({p - t for p, t in hits}):
        if last is None or d - last > licenses.SLACK:
            runs.append(set())
        runs[-1].add(d)
        last = d
    best = 0.0
    for run in runs:
        own = [(p, t) for p, t in hits if p - t in run]
        for p0, _ in own:
            best = max(best, len({t for p, t in own if p0 <= p and p + k <= p0 + allowed}) / grams)
    return best if best >= (1.0 if grams <= licenses.SHORT else licenses.COVERAGE) else 0.0


def test_the_best_stretch_of_random_texts(spark):
    """Texts of few words, in which diagonals run into each other."""
    rng = random.Random(4)
    templates = [("a", "x y z x w v"), ("b", "x y x y x z"), ("c", " ".join(rng.choice("xyzw") for _ in range(20)))]
    texts = []
    for _ in range(150):
        parts = []
        for _ in range(rng.randrange(1, 7)):
            t = rng.choice(templates)[1].split()
            parts += rng.choice([t, t[: rng.randrange(1, len(t))], [rng.choice("xyzwv") for _ in range(rng.randrange(6))], t[:3] * rng.randrange(4)])
        texts.append(" ".join(parts))
    got = labels(spark, texts, phrases=(), templates=templates)
    for i, text in enumerate(texts):
        best = {x: held(text.split(), t.split(), licenses.GRAM) for x, t in templates}
        assert got[i][1] == round(max(best.values()), 9), text
        assert set(filter(None, got[i][0].split(","))) <= {x for x, b in best.items() if b}
