import datetime as dt
import random

from pyspark.sql import functions as F

from tabspark.llm import linkage

SCHEMA = "id string, one string, two string, tour string, day date, weight double"


def _link(spark, left, right):
    frames = []
    for data in (left, right):
        df = spark.createDataFrame([(*r, 1.0) for r in data], SCHEMA)
        days = F.when(F.col("day").isNotNull(), F.array(F.unix_date("day"))).otherwise(F.array().cast("array<int>"))
        frames.append(linkage.records(df, "id", "one", "two", "tour", days))
    return {(r["left_id"], r["right_id"]) for r in linkage.link(*frames).collect()}


D = dt.date
LEFT = [
    ("m1", "Selwyn Laistoy", "Jarek Grussugh", "Dunmorrow Open", D(2020, 5, 1)),
    ("m2", "Selwyn Laistoy", "Petra Failkyk", "Dunmorrow Open", D(2020, 5, 2)),
    ("m3", "Adair Jubrérsen", "Rufus Paldikh-Cissavar", "Quarrygate Masters", D(2019, 2, 3)),
    ("m4", "Selwyn Laistoy", "Jarek Grussugh", "Dunmorrow Open", D(2021, 5, 1)),
    ("m5", "Edda Vomack", "Benno Sternesko", None, None),
]


def test_spellings_orders_and_neighbouring_matches(spark):
    right = [
        ("l1", "GRUSSUGH J.", "S. Laistoy", "DUNMORROW_OPEN", D(2020, 5, 2)),
        ("l2", "Failkyk, Petra", "Laistoi", "Dunmorrow", D(2020, 5, 2)),
        ("l3", "Paldikh Cissavar", "A Jubrersen", "Sable Masters Quarrygate", D(2019, 2, 4)),
        ("l4", "Jarek Grussugh", "Selwyn Laistoy", "Dunmorrow Open 2021", None),
        ("l5", "E. Vomack", "Sternesko B.", "Larchhaven Cup", D(2018, 1, 1)),
        ("l6", "Selwyn Laistoy", "Nils Costack", "Dunmorrow Open", D(2020, 5, 1)),
        ("l7", "Selwyn Laistoy", "Jarek Grussugh", "Dunmorrow Open", D(2019, 5, 1)),
        ("l8", None, "Jarek Grussugh", "Dunmorrow Open", D(2020, 5, 1)),
        ("l9", "", "", "", None),
    ]
    assert _link(spark, LEFT + LEFT[:1], right + right[:1]) == {("m1", "l1"), ("m2", "l2"), ("m3", "l3"), ("m4", "l4"), ("m5", "l5")}


def _sides(spark, n):
    """Matches of one surname at one place, so that keys without a day are common; the listings have no day."""
    places, names = ["Dunmorrow Open", "Larchhaven Cup"], [f"{a}{b}{c}sky" for a in "BKMTV" for b in "aeiou" for c in ("rn", "ld", "ss")]
    left = [(f"m{i}", "Selwyn Laistoy", f"Nils {names[i]}", places[i % 2], D(2020, 1, 1) + dt.timedelta(i)) for i in range(n)]
    right = [(f"l{i}", f"N. {names[i]}", "S. Laistoy", places[i % 2], None) for i in range(n)]
    return left, right


def test_common_keys_are_refined_without_losing_links(spark, caplog):
    left, right = _sides(spark, 60)
    frames = []
    for data in (left, right):
        df = spark.createDataFrame([(*r, 1.0) for r in data], SCHEMA)
        days = F.when(F.col("day").isNotNull(), F.array(F.unix_date("day"))).otherwise(F.array().cast("array<int>"))
        frames.append(linkage.records(df, "id", "one", "two", "tour", days))
    keys = [linkage._keys(frames[0], 1, True), linkage._keys(frames[1], 0, False)]
    whole = linkage._pairs_by_rare_keys(*keys, 0.4, block_pairs=10**9)
    with caplog.at_level("INFO"):
        fine = linkage._pairs_by_rare_keys(*keys, 0.4, block_pairs=50)
    assert "level 1" in caplog.text
    true = {(f"m{i}", f"l{i}") for i in range(60)}
    assert true <= {(r[0], r[1]) for r in fine.collect()} and fine.count() <= whole.count()
    assert {(r[0], r[1]) for r in linkage.link(*frames, block_pairs=50).collect()} == true


def test_recall_and_precision_on_noisy_copies(spark):
    """Copies with initials, swapped players, slips of the pen, shifted or missing days and shortened places; a third of the listings are of other matches."""
    r = random.Random(11)
    syllables = [a + b for a in "bdfgklmnprstvz" for b in "aeiou"]
    word = lambda n: "".join(r.choice(syllables) for _ in range(n))
    people = [(word(2).title(), word(3).title()) for _ in range(60)]
    places = [f"{word(3).title()} {k}" for k in ("Open", "Cup", "Masters") for _ in range(4)]

    def slip(name):
        i = r.randrange(1, len(name) - 1)
        return r.choice([name[:i] + name[i + 1 :], name[:i] + name[i + 1] + name[i] + name[i + 2 :], name])

    def spelled(person):
        first, last = person
        return r.choice([f"{first} {last}", f"{first[0]}. {last}", f"{last} {first[0]}.", f"{last}, {first}", f"{first} {slip(last)}", f"{first} {last}".upper()])

    left, right, true = [], [], set()
    for i in range(240):
        one, two = r.sample(people, 2)
        place, day = r.choice(places), D(2015, 1, 1) + dt.timedelta(r.randrange(1500))
        left.append((f"m{i:03d}", " ".join(one), " ".join(two), place, day))
        if i % 3:
            pair = [one, two] if r.random() < 0.5 else [two, one]
            shown = r.choice([place, place.split()[0], place.upper().replace(" ", "_"), None])
            when = None if shown and r.random() < 0.1 else day + dt.timedelta(r.choice([-1, 0, 0, 0, 1]))
            right.append((f"l{i:03d}", spelled(pair[0]), spelled(pair[1]), shown, when))
            true.add((f"m{i:03d}", f"l{i:03d}"))
        else:
            a, b = r.sample(people, 2)
            right.append((f"l{i:03d}", spelled(a), spelled(b), r.choice(places), D(2015, 1, 1) + dt.timedelta(r.randrange(1500))))
    got = _link(spark, left, right)
    assert len(got & true) / len(true) >= 0.97 and len(got & true) / len(got) >= 0.97


def test_empty_sides(spark):
    assert _link(spark, [], [("l1", "A B", "C D", None, None)]) == set()
    assert _link(spark, LEFT, []) == set()


def test_name_parts(spark):
    names = ["V. Pliskolde", "V Farvavar", "Gairrard N.", "Wobringham, Edda", "Peidrowe", "NADJA  TRIRNISTO", "Jolanda Digaldo-Gibrersen", "Poülvowe", " ", None]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i long, n string").select("i", linkage.name_parts(F.col("n")).alias("p"))
    got = [None if r["p"] is None else (r["p"]["first"], r["p"]["last"]) for r in df.orderBy("i").collect()]
    assert got == [("v", "pliskolde"), ("v", "farvavar"), ("n", "gairrard"), ("edda", "wobringham"), ("", "peidrowe"), ("nadja", "trirnisto"), ("jolanda", "digaldogibrersen"), ("", "poulvowe"), None, None]


def test_rounds_go_on_until_nothing_moves_and_end_in_a_cycle(spark):
    start = spark.createDataFrame([(0, 1, 0.8)], "left_id long, right_id long, score double")
    late = lambda df: df.withColumn("left_id", F.least(F.col("left_id") + 1, F.lit(9)))
    got, rounds = linkage._settled(start, late)
    assert got.first()["left_id"] == 9 and rounds == 10
    swing = lambda df: df.withColumn("left_id", 1 - F.col("left_id")).withColumn("score", F.when(F.col("left_id") == 1, 0.9).otherwise(0.8))
    got, rounds = linkage._settled(start, swing)
    assert got.first()["left_id"] == 1 and rounds == 2
    assert linkage._settled(start.limit(0), late)[0].count() == 0
