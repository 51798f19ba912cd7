"""Tables that change by commits: whole for readers, safe for two writers at once, untouched where nothing changed."""

import os
import threading
from datetime import date
from glob import glob

import pytest
from pyspark.sql import functions as F

from panelmill.operators.scd2 import scd2_apply, versions
from panelmill.sources import commits


def days(spark, values):
    return spark.createDataFrame(values, "symbol string, date date, x double")


def base(spark):
    return days(spark, [(s, date(2020, m, 1), float(m)) for s in "AB" for m in range(1, 7)])


@pytest.fixture
def month_of(spark):  # noqa: N802
    return F.date_format("date", "yyyy-MM")


def rows(df):
    return sorted(map(str, map(tuple, df.collect())))


def files(folder):
    return {f: os.stat(f).st_mtime_ns for f in glob(f"{folder}/data/**/*.parquet", recursive=True)}


@pytest.fixture
def at(tmp_path):
    return f"file://{tmp_path}/t"


def test_merge_leaves_other_partitions(spark, at, tmp_path, month_of):
    commits.rebuild(base(spark), at, month_of, ["symbol"])
    before = files(tmp_path / "t")
    first = commits.load(spark, at)
    commits.merge(days(spark, [("A", date(2020, 3, 1), 30.0), ("C", date(2020, 3, 1), 31.0), ("A", date(2020, 9, 1), 90.0)]), at, ["symbol", "date"], month_of)
    now, after = commits.load(spark, at), files(tmp_path / "t")
    assert {p for p in now.parts if now.parts[p] != first.parts.get(p)} == {"p-2020-03", "p-2020-09"}
    assert all(after[f] == t for f, t in before.items())  # the old files are all there, the merge only adds
    assert {os.path.basename(os.path.dirname(f)) for f in set(after) - set(before)} == {f"{commits.PART}=p-2020-03", f"{commits.PART}=p-2020-09"}
    want = {("A", 3): 30.0, ("C", 3): 31.0, ("A", 9): 90.0}
    got = {(r.symbol, r.date.month): r.x for r in commits.read(spark, at).collect()}
    assert got == {(s, m): float(m) for s in "AB" for m in range(1, 7)} | want
    # only the partitions that the updates concern are read
    assert {os.path.basename(os.path.dirname(f)) for f in commits.read(spark, at, parts=["p-2020-03"]).inputFiles()} == {f"{commits.PART}=p-2020-03"}
    assert commits.discard_unread(spark, at, keep_versions=1) == 0  # both attempts are read
    assert rows(commits.read(spark, at, 2)) == rows(commits.read(spark, at))


def test_replace_by_key_and_by_window(spark, at, month_of):
    commits.rebuild(base(spark), at, month_of)
    commits.merge(days(spark, [("A", date(2020, 8, 1), 1.0)]), at, ["symbol"], month_of, keys_say_part=False)
    assert {(r.symbol, r.date.month) for r in commits.read(spark, at).collect()} == {("A", 8)} | {("B", m) for m in range(1, 7)}
    commits.replace_windows(days(spark, [("Z", date(2020, 2, 5), 7.0), ("Z", date(2020, 8, 9), 8.0)]), at, month_of)
    assert {(r.symbol, r.date.month) for r in commits.read(spark, at).collect()} == {("Z", 2), ("Z", 8)} | {("B", m) for m in (1, 3, 4, 5, 6)}
    number = commits.load(spark, at).number
    assert commits.replace_windows(base(spark).limit(0), at, month_of).number == number  # nothing to do, nothing committed


def test_readers_see_whole_tables(spark, at, monkeypatch):
    """A crash while data is written, before the commit, and in the middle of it; and a reader that began before a rebuild."""
    commits.rebuild(base(spark), at)
    old = rows(base(spark))
    new = base(spark).withColumn("x", F.col("x") + 100)
    with pytest.raises(Exception, match="torn"):
        commits.rebuild(new.withColumn("x", F.when(F.col("date") > "2020-04-01", F.raise_error(F.lit("torn")).cast("double")).otherwise(F.col("x"))), at)
    assert rows(commits.read(spark, at)) == old

    def dies(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(commits, "_claim", dies)
        with pytest.raises(RuntimeError, match="killed"):
            commits.rebuild(new, at)
    assert rows(commits.read(spark, at)) == old
    with monkeypatch.context() as m:
        m.setattr(commits.os, "link", dies)
        with pytest.raises(RuntimeError, match="killed"):
            commits.rebuild(new, at)
    assert rows(commits.read(spark, at)) == old and commits.versions(spark, at) == [1]
    reader = commits.read(spark, at)
    commits.rebuild(new, at)
    assert rows(reader) == old and rows(commits.read(spark, at)) == rows(new) and rows(commits.read(spark, at, 1)) == old
    assert commits.discard_unread(spark, at, keep_versions=1) == 4  # the first version's and three that were never committed
    assert rows(commits.read(spark, at)) == rows(new) and commits.versions(spark, at) == [2]


def together(*jobs):
    """Run jobs at once; what they raised."""
    errors, gate = [], threading.Barrier(len(jobs))

    def run(job):
        gate.wait()
        try:
            job()
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=run, args=(j,)) for j in jobs]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    return errors


def rounds(spark, months, run, n=50):
    return spark.createDataFrame([(date(2020, m, 28), "v1", f"s{i}", run) for m in months for i in range(n)], "as_of_date date, methodology_version string, symbol string, run int")


def test_first_write_wins_with_two_writers(spark, at, monkeypatch):
    added = {}
    write = lambda run, months: added.setdefault(run, commits.first_write(rounds(spark, months, run), at))
    # both see no table before either commits
    gate, claim = threading.Barrier(2), commits._claim
    waited = threading.local()

    def claim_together(*args):
        if not getattr(waited, "once", False):
            waited.once = True
            gate.wait(timeout=60)
        return claim(*args)

    with monkeypatch.context() as m:
        m.setattr(commits, "_claim", claim_together)
        assert not together(lambda: write(1, (1, 2)), lambda: write(2, (2, 3)))
    got = commits.read(spark, at).groupBy("as_of_date").agg(F.count("*").alias("n"), F.countDistinct("run").alias("runs")).collect()
    assert sorted((r.as_of_date.month, r.n, r.runs) for r in got) == [(1, 50, 1), (2, 50, 1), (3, 50, 1)]
    assert sorted(added[1] + added[2]) == [f"2020-0{m}-28|v1" for m in (1, 2, 3)]
    assert commits.first_write(rounds(spark, (1, 2, 3), 9), at) == []
    assert commits.first_write(rounds(spark, (3, 4), 9), at) == ["2020-04-28|v1"]
    assert {r.run for r in commits.read(spark, at).filter("as_of_date = '2020-04-28'").collect()} == {9}


def test_a_killed_writer_leaves_no_round(spark, at, monkeypatch):
    with monkeypatch.context() as m:
        m.setattr(commits, "_claim", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            commits.first_write(rounds(spark, (1,), 1), at)
    with pytest.raises(FileNotFoundError):
        commits.read(spark, at)
    commits.first_write(rounds(spark, (1,), 2), at)
    assert {(r.run, r["count"]) for r in commits.read(spark, at).groupBy("run").count().collect()} == {(2, 50)}


def test_two_merges_at_once(spark, at, month_of):
    commits.rebuild(base(spark), at, month_of)
    one = lambda s, m, x: lambda: commits.merge(days(spark, [(s, date(2020, m, 1), x)]), at, ["symbol", "date"], month_of)
    assert not together(one("A", 1, 10.0), one("B", 1, 20.0), one("A", 2, 30.0))  # two in one month, one in another
    got = {(r.symbol, r.date.month): r.x for r in commits.read(spark, at).collect()}
    assert got == {(s, m): float(m) for s in "AB" for m in range(1, 7)} | {("A", 1): 10.0, ("B", 1): 20.0, ("A", 2): 30.0}


def test_trials_count_on(spark, at):
    new = lambda *names: spark.createDataFrame([(n,) for n in names], "variant string")
    commits.log_trials(new("a", "b"), at, "variant")
    assert not together(lambda: commits.log_trials(new("c"), at, "variant"), lambda: commits.log_trials(new("d", "e"), at, "variant"))
    log = {r.trial: r.variant for r in commits.read(spark, at).collect()}
    assert sorted(log) == [1, 2, 3, 4, 5] and set(log.values()) == set("abcde") and log[1] == "a"


def test_versions_by_bucket(spark, at):
    history = spark.createDataFrame([(f"k{i}", "a", 1) for i in range(40)], "k string, v string, ts int")
    current = versions(history, "k", ["v"], "ts")
    commits.rebuild(current, at, commits.bucket_of("k", 8))
    first = commits.load(spark, at)
    updates = spark.createDataFrame([("k1", "b", 5), ("k2", "a", 5), ("new", "c", 5)], "k string, v string, ts int")
    commits.merge_versions(updates, at, "k", ["v"], "ts", 8)
    now = commits.load(spark, at)
    assert rows(commits.read(spark, at).select(current.columns)) == rows(scd2_apply(current, updates, "k", ["v"], "ts").select(current.columns))
    assert 1 <= sum(now.parts[p] != first.parts.get(p) for p in now.parts) <= 3
    with pytest.raises(FileNotFoundError):
        commits.merge_versions(updates, f"{at}-none", "k", ["v"], "ts")


def test_refused_rows_are_not_committed(spark, at, month_of):
    checks = {"negative": F.count_if(F.col("x") < 0), "no_symbol": F.count_if(F.col("symbol").isNull())}
    commits.rebuild(base(spark), at, month_of, checks=checks)
    bad = days(spark, [("A", date(2020, 1, 1), -1.0), (None, date(2020, 1, 1), -2.0)])
    with pytest.raises(commits.ChecksFailed) as e:
        commits.rebuild(bad, at, month_of, checks=checks)
    assert e.value.failures == {"negative": 2, "no_symbol": 1} and commits.versions(spark, at) == [1]


def test_odd_partitions_and_columns(spark, at):
    odd = spark.createDataFrame([(x, 1) for x in (None, "", "a/b=c%d e", "1", "2020-01-01", "__HIVE_DEFAULT_PARTITION__", "é")], "k string, v int")
    commits.rebuild(odd, at, F.col("k"))
    assert rows(commits.read(spark, at)) == rows(odd)
    commits.merge(spark.createDataFrame([("a/b=c%d e", 2, "n")], "k string, v long, extra string"), at, ["k"], F.col("k"))
    got = {r.k: (r.v, r.extra) for r in commits.read(spark, at).collect()}
    assert got["a/b=c%d e"] == (2, "n") and got["1"] == (1, None) and len(got) == 7
    assert dict(commits.read(spark, at).dtypes)["v"] == "int"  # a column keeps its type
    commits.append(spark.createDataFrame([("x", True)], "k string, flag boolean"), at)
    assert commits.read(spark, at).columns == ["k", "v", "extra", "flag"] and commits.read(spark, at).count() == 8
    commits.rebuild(odd.limit(0), at)
    assert commits.read(spark, at).count() == 0 and commits.read(spark, at).columns == ["k", "v"]
