"""Joins on likeness against the loop over all pairs."""

import random

import pandas as pd

from lectern.functions import fuzzy
from lectern.operators import likeness

FIRST = "Anna Maria Luis Ignacio João Emile Basirou Khalil Thongsavanh Édith Hilda Matthew Ilídio Nawaf Ali Falih Sergei Wei Nguyen Fatima Olena Petra Håkon Zoë".split()
LAST = "Salam Zaidi Prado Costa Martin Phomvihane Tassyla Heine Wale Vieira Marape Pierre Hanley Friday Beccari Albusaidi Munoz Pardo Lavrov Zhang Okonkwo Rasmussen Novak Quiroga".split()
PLACES = ["Lebanon", "Iraq", "Brazil", "France", "Lao People's Democratic Republic", "Gabon", "Oman", "San Marino", "Marshall Islands", "Solomon Islands", "Saint Lucia", "Norway", "Guinea-Bissau", "Papua New Guinea", ""]
TITLES = ["President", "Prime Minister", "Minister of Foreign Affairs", "King", ""]
HEARD_PLACES = ["Lebanese Republic", "Brasil", "Marsh Islands", "Gabun", "Aman", "St Lucia", "Republic of Guinea-Bissau", "Norwai", "Law, People's Democratic Republic", "General Assembly", "Iraqi", ""]


def garbled(name, rng):
    """A name as a recogniser may hear it: letters lost, doubled or replaced, a space moved, a part left out."""
    letters = list(name)
    for _ in range(rng.choice([0, 1, 1, 2, 3])):
        i = rng.randrange(len(letters))
        letters[i] = rng.choice(["", letters[i] * 2, rng.choice("aeiounrst "), " "])
    heard = "".join(letters)
    return rng.choice([heard, heard, heard.upper(), heard.split(" ")[-1], f"Mr. {heard}"])


def people(rng, n):
    return [(f"{rng.choice(FIRST)} {rng.choice(LAST)}" + rng.choice(["", "", f" {rng.choice(LAST)}"]), rng.choice(PLACES), rng.choice(TITLES)) for _ in range(n)]


def test_names_and_countries_equal_the_loop_over_all_pairs(spark):
    rng = random.Random(11)
    agenda = [*people(rng, 120), ("", "Iraq", "King"), ("Anna Salam", "Norway", "President"), ("Dr. de la", "Oman", "")]
    heard = []
    for _ in range(260):
        name, country, title = rng.choice(agenda)
        said = rng.choice([f"{title} of {country}", f"{title} of the {rng.choice(HEARD_PLACES)}", "", title])
        heard.append((garbled(name, rng) if name and rng.random() < 0.8 else rng.choice(["", "unknown", " Unknown ", None]), said or None, rng.choice([None, "", country, rng.choice(HEARD_PLACES)])))
    heard += [(None, None, None), ("", "President of Norway", ""), *heard[:5]]
    frame = spark.createDataFrame([(i, *h) for i, h in enumerate(heard)], "i long, name string, title string, country string").repartition(3)
    listed = spark.createDataFrame([(1000 + i, *a) for i, a in enumerate(agenda)], "position long, name string, country string, title string")
    got = {r.i: (r.position, r.found_by) for r in likeness.match_roster(frame, listed).collect()}
    for i, h in enumerate(heard):
        found = fuzzy.match(*[x or "" for x in h], agenda)
        assert got[i] == ((None, None) if found is None else (1000 + found[0], found[1])), h
    assert len(got) == len(heard) and len({g[1] for g in got.values()}) == 3
    assert {r.position for r in likeness.match_roster(frame, listed.limit(0)).collect()} == {None}
    assert likeness.match_roster(frame.limit(0), listed).collect() == []


def test_few_pairs_are_measured_and_none_is_lost(spark):
    """Of 450 by 450 words the letters leave a small share to be measured, and every pair that is like enough is among them."""
    rng = random.Random(12)
    words = lambda: sorted({"".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 12))) for _ in range(450)})
    left = words()
    right = sorted({*words()[:400], *(garbled(w, rng).lower().strip() or "x" for w in left[:110])})
    a, b = (spark.createDataFrame([(w,) for w in x], "t string") for x in (left, right))
    for least in (0.86, likeness.WORD_LIKENESS):
        pairs = {(r.a, r.b) for r in likeness.candidates(a, b, least).collect()}
        want = {(x, y) for x in left for y in right if abs(len(x) - len(y)) <= 14 and max(fuzzy.ratio(x, y), fuzzy.ratio(y, x)) >= least}
        assert want <= pairs and len(pairs) < (0.002 if least > 0.8 else 0.12) * len(left) * len(right)
        assert {(r.a, r.b) for r in likeness.like_pairs(a, b, least).collect()} == want


def test_a_country_of_very_many_is_one_row_for_each_role(spark):
    agenda = spark.createDataFrame([(i, f"Person{i} Surname{i}", "Norway", "President" if i == 77 else "Minister") for i in range(20_000)], "position long, name string, country string, title string")
    asked = spark.createDataFrame([("Norway", "President of Norway"), ("Norway", "Minister"), ("Norway", "")], "place string, title string")
    assert [(r.title, r.position) for r in likeness.by_country(asked, agenda).collect()] == [("President of Norway", 77)]


def test_keys_of_letters_are_not_broadcast(spark):
    """A word has hundreds of keys, which a plan takes for one row."""
    words = spark.createDataFrame([("abcdefgh",), ("abcdexyz",)], "t string")
    found = likeness.candidates(words, words, 0.6)
    joins = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in line]
    assert joins and all("merge" in line for line in joins)
    assert {tuple(r) for r in found.collect()} >= {("abcdefgh", "abcdexyz"), ("abcdexyz", "abcdefgh")}


def test_names_that_are_well_heard_meet_few_others(spark):
    """Of 600 by 600 made-up words like those of roster_match one pair in thirteen had been measured."""
    rng = random.Random(13)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    left, right = (spark.createDataFrame([(word(rng.choice(sizes)),) for _ in range(600)], "t string") for sizes in ((7, 11), (8, 10)))
    assert likeness.candidates(left, right, likeness.WORD_LIKENESS).count() < 0.02 * 600 * 600
    assert likeness.candidates(left, right, likeness.word_likeness(likeness.LEVELS[0])).count() < 0.0005 * 600 * 600


def test_names_go_down_the_levels_until_no_entry_can_change_the_answer(spark):
    """Best scores from all levels, rivals within and beyond the margin on either side of a level, entries of one name, and others by surname."""
    rng = random.Random(14)
    listed = [n for n, _, _ in people(rng, 60)]
    listed += [garbled(rng.choice(listed), rng) for _ in range(60)] + listed[:6] + ["Bo Unusualname", "Ann Unusualnane"]
    agenda = [(n, "", "") for n in listed]
    said = sorted({garbled(garbled(rng.choice(listed), rng) or "x", rng) for _ in range(220)} | {"Xy Unusualname", "qqq zzz"} - {""})
    got = {r.name: (r.position, r.score) for r in likeness.by_name(spark.createDataFrame([(n,) for n in said], "name string"), spark.createDataFrame(list(enumerate(listed)), "position long, name string")).collect()}
    want = {n: fuzzy._by_name(n, agenda, fuzzy.NAME_THRESHOLD) for n in said}
    assert got == {n: w for n, w in want.items() if w}
    best = [max(fuzzy.name_score(n, x) for x in listed) for n in said]
    assert all(sum(low <= b < low + 0.08 for b in best) > 5 for low in likeness.LEVELS) and sum(b >= 0.86 for b in best) > 20


def test_letters_shared_in_order():
    rng = random.Random(15)
    word = lambda: "".join(rng.choice("abcdé\0") for _ in range(rng.choice([1, 5, 20, 63, 64])))
    pairs = [(word(), word()) for _ in range(300)]
    for (a, b), found in zip(pairs, fuzzy.shared_in_order(*map(pd.Series, zip(*pairs)))):
        row = [0] * (len(b) + 1)
        for x in a:
            row = _step(row, x, b)
        assert found == (row[-1] if max(len(a), len(b)) <= 63 else min(len(a), len(b)))


def _step(row, x, b):
    out = [0]
    for j, y in enumerate(b):
        out.append(row[j] + 1 if x == y else max(row[j + 1], out[j]))
    return out
