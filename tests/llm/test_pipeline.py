import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
from tokenizers import Tokenizer

import corpus_pipeline
from panelmill.llm import quality
from panelmill.llm.mixing import mix
from panelmill.llm.queries import tokenizer_path
from test_corpus_operators import wanted_targets, words
from test_ngram_join import brute

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def windows(items):
    """Word windows of the items: ten words, or all of a shorter item."""
    out = set()
    for item, text in items:
        w = words(text)
        m = min(10, len(w))
        out |= {tuple(w[k : k + m]) for k in range(len(w) - m + 1) if m and item is not None}
    return out


def leaks(text, wins):
    w = words(text)
    return any(tuple(w[k : k + m]) in wins for m in {len(x) for x in wins} for k in range(len(w) - m + 1))


def encoded(rows):
    """(doc_id, start, n_tokens, crc) of rows in order, by the library itself."""
    library, at, out = Tokenizer.from_file(tokenizer_path()), 0, Counter()
    for i, text in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or "")):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        out[i, at, len(ids) // 4, zlib.crc32(ids)] += 1
        at += len(ids) // 4
    return out


def rows_of(df):
    return Counter((r.doc_id, r.text, r.source) for r in df.collect())


def test_stages_hold_against_brute_force(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out, kept = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        was = out
        out = stage(spark, out, SF)
        out = spark.createDataFrame(out.toPandas(), out.schema)
        kept[name] = was, out
        if name != "tokens":
            assert out.columns == documents.columns
    before, after = kept["quality"]  # test_models holds classify against the textbook
    good = {r.doc_id for r in quality.classify(before, labels).collect() if r.predicted}
    assert rows_of(after) == Counter({k: n for k, n in rows_of(before).items() if k[0] in good}) and 0 < len(good) < before.count()
    known = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    assert np.mean([(i in good) == bool(q) for i, q in known.items()]) > 0.95
    before, after = kept["near_duplicates"]
    want = brute([(r.doc_id, r.text) for r in before.collect()])
    assert sorted(r.doc_id for r in after.collect()) == sorted(i for i in want if want[i][0] == i)
    before, after = kept["decontamination"]
    wins = windows([(r["item_id"], r["text"]) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()])
    assert rows_of(after) == Counter({k: n for k, n in rows_of(before).items() if not leaks(k[1], wins)}) and after.count() < before.count()
    before, after = kept["mixing"]
    times = Counter(r.doc_id for r in after.collect())
    assert times == Counter({r.doc_id: r.copies for r in mix(before).collect() if r.copies})
    sizes, taken = Counter(), Counter()
    for (_, text, source), n in rows_of(before).items():
        sizes[source] += n * len((text or "").split())
    for (_, text, source), n in rows_of(after).items():
        taken[source] += n * len((text or "").split())
    longest = max(len((k[1] or "").split()) for k in rows_of(before))
    for source, target in wanted_targets(sizes).items():
        assert target - longest <= taken[source] <= target + 1e-6
    before, after = kept["tokens"]
    assert Counter((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in after.collect()) == encoded([(r.doc_id, r.text) for r in before.collect()])


def test_stages_with_odd_rows(spark):
    """Null and repeated ids, null and empty texts, ties, clashing columns, no rows."""
    item = next(r["text"] for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist() if len((r["text"] or "").split()) >= 12)
    plain = next(r["text"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist() if r["text"] and 80 < len(r["text"].split()) < 200)
    schema = "doc_id long, text string, lang string, source string, n_chars long, x string, copies int, row long"
    rows = [(None, item), (1, item), (2, plain), (2, plain), (None, plain), (3, None), (4, ""), (None, None), (5, plain + " " + item), (6, "tie"), (6, "tie")]
    docs = spark.createDataFrame([(i, t, "en", "s" if k % 3 else None, len(t or ""), "x", 7, 8) for k, (i, t) in enumerate(rows)], schema)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).collect() == []
        if name != "tokens":
            assert stage(spark, docs, SF).columns == docs.columns
    scores = {r.text: r.predicted for r in quality.classify(docs, labels).join(docs.select("doc_id", "text"), "doc_id").collect()}
    stay = Counter((r.doc_id, r.text) for r in STAGES["quality"](spark, docs, SF).collect())
    every = Counter((r.doc_id, r.text) for r in docs.collect())
    assert stay == Counter({k: n for k, n in every.items() if scores[k[1]]})
    clean = Counter((r.doc_id, r.text) for r in STAGES["decontamination"](spark, docs, SF).collect())
    assert clean == Counter({k: n for k, n in every.items() if item not in (k[1] or "")})
    one = Counter((r.doc_id, r.text) for r in STAGES["near_duplicates"](spark, docs, SF).collect())
    assert one[None, plain] == 1 and one[None, item] == 1 and one[2, plain] == 2 and one[1, item] == 1 and one[3, None] == 1 and one[6, "tie"] == 2
    mixed = Counter((r.doc_id, r.text) for r in STAGES["mixing"](spark, docs, SF).collect())
    assert set(mixed) <= set(every) and all(mixed[k] <= 2 * every[k] for k in mixed)
    assert Counter((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in STAGES["tokens"](spark, docs, SF).collect()) == encoded(rows)


def test_queries_are_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {"pipeline"} < names and all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))
    assert set(__spark_entry__.oracle_sql()) <= names
