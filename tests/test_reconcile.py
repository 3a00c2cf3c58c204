import random

from landfall.operators import star
from landfall.operators.reconcile import reconcile


def frame(spark, names, column="x"):
    return spark.createDataFrame([(n,) for n in names], f"{column} string").repartition(3)


def found(spark, names, known, **how):
    rows = reconcile(frame(spark, names), frame(spark, known, "y"), **how).collect()
    return {r["name_key"]: (r["known_key"], round(r["score"], 4)) for r in rows}


def distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y)))
        last = now
    return last[-1]


def test_mutual_best_above_the_threshold(spark):
    names = ["Velmor Republic", "Isle of Tarn", "Grand Duchy of Ossa", "Twin-Suns", "NORTHLAND", "Rep. of X", None, "", "--", "Velmor Republic"]
    known = ["Velmoor Republic", "Velmor Republics", "Tarn Isle", "Duchy of Ossa", "TWIN SUNS", "Southland", "of", None, "!!"]
    assert found(spark, names, known, least=0.6) == {
        "velmor republic": ("velmoor republic", 0.9375), "grand duchy of ossa": ("duchy of ossa", 0.6842),
    }
    assert found(spark, names, known, least=0.9) == {"velmor republic": ("velmoor republic", 0.9375)}
    assert found(spark, [], known) == {} and found(spark, names, []) == {}


def test_against_brute_force(spark):
    rng = random.Random(3)
    stems = [f"{a}{b}ar" for a in "bdkm" for b in "aeiou"]
    names = {f"land {rng.choice(stems)} {rng.choice(stems)}" for _ in range(60)}
    known = {n.replace("a", "e", 1) if rng.random() < 0.5 else n + "s" for n in rng.sample(sorted(names), 40)} | set(rng.sample(sorted(names), 10))
    a, b = names - known, known - names
    uses = {}
    for n in [*a, *b]:
        for w in set(n.split()):
            uses[w] = uses.get(w, 0) + 1
    rare = {n: sorted(set(n.split()), key=lambda w: (uses[w], w))[:2] for n in a | b}
    score = {(x, y): 1 - distance(x, y) / max(len(x), len(y)) for x in a for y in b if set(rare[x]) & set(rare[y])}
    score = {p: s for p, s in score.items() if s >= 0.8}
    best_a = {x: min(((-s, y) for (u, y), s in score.items() if u == x))[1] for x in {p[0] for p in score}}
    best_b = {y: min(((-s, x) for (x, v), s in score.items() if v == y))[1] for y in {p[1] for p in score}}
    wanted = {x: (y, round(score[x, y], 4)) for x, y in best_a.items() if best_b[y] == x}
    assert len(wanted) > 5 and found(spark, sorted(names), sorted(known)) == wanted


def test_mapped_names_join(spark):
    fact = spark.createDataFrame([(1, "Velmor Republic"), (2, "Northland"), (3, None)], "immigration_id long, country_of_residence string")
    countries = spark.createDataFrame([("Velmoor Republic", 4.0), ("NORTHLAND", 2.0)], "country string, average_temperature double")
    mapping = reconcile(fact.select("country_of_residence"), countries.select("country"))
    joined = star.join_country(fact, countries, mapping=mapping).collect()
    assert {r["immigration_id"]: r["average_temperature"] for r in joined} == {1: 4.0, 2: 2.0, 3: None}
    plain = star.join_country(fact, countries).collect()
    assert {r["immigration_id"]: r["average_temperature"] for r in plain} == {1: None, 2: 2.0, 3: None}
