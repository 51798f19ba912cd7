import random
import re

import numpy as np
from pyspark.sql import functions as F

from panelmill.llm.components import components
from panelmill.llm.ngram_join import JaccardParams, keep_one, least_matches, near_duplicates
from panelmill.llm.shared import join_groups

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text, n=5):
    words = WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute(rows):
    sets = {i: grams(t) for i, t in rows}
    links = {i: set() for i, _ in rows}
    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
                links[a].add(b)
                links[b].add(a)
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i in ids:
            least = min([label[i], *(label[j] for j in links[i])])
            changed |= least != label[i]
            label[i] = least
    return {i: (label[i], len(links[i])) for i in ids}


def corpus(seed=3):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 7)))
    rows = []
    for _ in range(30):
        base = [word() for _ in range(r.randint(30, 120))]
        rows.append(" ".join(base))
        for _ in range(r.randint(0, 6)):
            copy = base.copy()
            for _ in range(r.randint(0, 3)):
                copy[r.randrange(len(copy))] = word()
            rows.append(r.choice([" ", "\n", ", "]).join(copy))
    rows += [None, "", "!!", "one two", "One, two", "é", "x" * 3_000_000 + " tail", *["same text over and over again"] * 40]
    r.shuffle(rows)
    return list(enumerate(rows))


def test_equals_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x", 7, 1) for i, t in rows], "doc_id long, text string, links string, class_id int, root int")
    want = brute(rows)
    for p in (JaccardParams(), JaccardParams(block_texts=8)):
        got = {r.doc_id: (r.class_id, r.n_links) for r in near_duplicates(docs, p).collect()}
        assert got == want
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i in want if want[i][0] == i)


def test_empty_and_repeated(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).collect() == []
    twice = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.class_id or 0, r.n_links) for r in near_duplicates(twice).collect())
    assert got == [(0, 0, 0), (1, 1, 1), (1, 1, 1)]


def dropped(s, need, step):
    """The probability that a pair of similarity s falls below one of the needed numbers of matches."""
    p = s + (1 - s) / 256
    coin, alive, lost = np.array([1.0]), np.array([1.0]), 0.0
    for _ in range(step):
        coin = np.convolve(coin, [1 - p, p])
    for n in need:
        alive = np.convolve(alive, coin)
        lost += alive[:n].sum()
        alive[:n] = 0
    return lost


def test_pruning_drops_far_fewer_links_than_the_bands():
    p = JaccardParams()
    need = least_matches(p.threshold, list(range(p.bands, p.bands * p.rows + 1, p.bands)), p.tolerance)
    unmet = (1 - p.threshold**p.rows) ** p.bands
    assert dropped(p.threshold, need, p.bands) < unmet / 100
    assert dropped(0.85, need, p.bands) < 1e-9


def test_star_stays_where_it_is(spark):
    """The leaves of a hub aren't shuffled by the hub: it goes to every task."""
    leaves = spark.range(1, 20_001).selectExpr("id as u", "0L as v")
    few = spark.range(100).selectExpr("50000 + 2 * id as u", "50001 + 2 * id as v")
    edges = leaves.unionByName(few)
    groups = edges.groupBy("v").agg(F.max("u").alias("m"), F.count("*").alias("n"))
    joined = join_groups(edges, groups, ["v"], 20_100)
    assert joined.filter("v = 0").count() == 20_000 and joined.count() == 20_100
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 or plan.count("BroadcastHashJoin") == 3
    roots = {r.node: r.root for r in components(edges).collect()}
    assert len(roots) == 20_201 and all(roots[i] == 0 for i in range(20_001)) and all(roots[50001 + 2 * k] == 50000 + 2 * k for k in range(100))


def test_pairs_across_the_edge_of_a_bucket(spark):
    """Texts that link to each other, but of which only some are near the smallest id of the buckets that all are in."""
    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(6))
    rows = []
    for g in range(12):
        shared = [word() for _ in range(r.randint(40, 90))]
        rows.append(" ".join(shared + [word() for _ in range(len(shared))]))  # the smallest id: half of it is theirs
        own = [word() for _ in range(r.randint(10, 60))]
        for k in range(12):  # a chain: each keeps most of the one before
            own = own[r.randint(0, 2) :] + [word() for _ in range(r.randint(0, 2))]
            rows.append(" ".join(shared + own))
    rows = list(enumerate(rows))
    want = brute(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: (x.class_id, x.n_links) for x in near_duplicates(docs, JaccardParams(block_texts=5)).collect()}
    assert got == want and sum(n for _, n in want.values()) > 100


def test_rows_that_share_an_id_but_not_a_text(spark):
    """Each row links by its own text, in whichever order rows come; such rows stay or go one by one."""
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(5))
    a, b, c = ([word() for _ in range(60)] for _ in range(3))
    near = lambda x: " ".join([*x[:-1], word()])
    rows = [(1, " ".join(a)), (1, " ".join(b)), (5, near(b)), (6, near(a)), (5, " ".join(c)), (None, " ".join(a)), (1, " ".join(b))]
    want = [(None, None, 0), (1, 1, 1), (1, 1, 2), (1, 1, 2), (5, 1, 2), (5, 5, 0), (6, 1, 1)]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame([(i, t, 9) for i, t in order], "doc_id long, text string, _set int").coalesce(1)
        got = sorted(((x.doc_id, x.class_id, x.n_links) for x in near_duplicates(docs).collect()), key=str)
        assert got == sorted(want, key=str)
        kept = keep_one(docs)
        stay = [(i, t) for i, t in order if i in (1, None) or t == " ".join(c)]
        assert kept.columns == docs.columns and sorted(((x.doc_id, x.text) for x in kept.collect()), key=str) == sorted(stay, key=str)
