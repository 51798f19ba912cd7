import base64
import gc
import hashlib
import math
import pickle
import random
import re
import weakref
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelmill.llm import chat, decontaminate, langid, quality, token_files, toxicity, warc
from panelmill.llm.components import components
from panelmill.llm.decontaminate import DecontaminationParams, find_benchmark, without_benchmark
from panelmill.llm.exact_dedup import exact_duplicates
from panelmill.llm.mixing import mix, mixed
from panelmill.llm.queries import tokenizer_path
from panelmill.llm.sampling import bounded_sample
from panelmill.llm.shared import place
from panelmill.llm.textkernel import WordHasher, slices, texts

DOCS = "doc_id long, text string, source string, kept int, row string, best string, run int, digest string, size int, n long"
ODD = [None, "", " \n\t ", "é", "a\x0bb", "ab", "a b", "x" * 2_500_000, "...", "1 2 3"]


def documents(spark, rows):
    """(doc_id, text, source) rows with columns whose names clash with internal ones."""
    return spark.createDataFrame([(i, t, s, 1, "r", "b", 2, "d", 3, 4) for i, t, s in rows], DOCS)


def odd(spark):
    rows = [(i, t, "s") for i, t in enumerate(ODD)]
    return documents(spark, [*rows, (3, "é", None), (3, "é", None), (None, "null id", "s")])


# --- exact dedup ----------------------------------------------------------------------------------------------------


def test_exact_dedup(spark):
    r = random.Random(1)
    rows = [(i, t, "s") for i, t in enumerate(ODD * 3)] + [(1000 + i, r.choice(["q w", "qw", "q\tw ", "qw"]), "s") for i in range(300)]
    r.shuffle(rows)
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i))
    want = {}
    for text, members in groups.items():
        keep = min(members)[1]
        for _, i in members:
            want[i] = (keep, len(members), i == keep, hashlib.sha256(text.encode()).hexdigest())
    for fan_in in (2, 8):
        got = exact_duplicates(documents(spark, rows), fan_in).collect()
        assert {x.doc_id: (x.keep_id, x.group_size, x.kept, x.text_sha256) for x in got} == want


def test_exact_dedup_repeated_and_empty(spark):
    got = exact_duplicates(odd(spark)).collect()
    assert len(got) == len(ODD) + 3
    assert sum(x.kept for x in got if x.doc_id == 3) == 1 and next(x for x in got if x.doc_id is None).kept
    assert exact_duplicates(documents(spark, [])).collect() == []


# --- token files ----------------------------------------------------------------------------------------------------


def test_coding_round_trip():
    r = np.random.default_rng(0)
    for n in (0, 1, 3, 4, 5, 1000):
        v = (r.integers(0, 2**32, n, dtype=np.uint64) >> r.integers(0, 32, n).astype(np.uint64)).astype(np.uint32)
        control, data = token_files.pack(v)
        assert (token_files.unpack(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), n) == v).all()


def test_encoder_equals_library():
    encoder, r = token_files.Encoder(tokenizer_path(), 50), random.Random(2)
    bits = ["the", " dog", "'s", "'ll", "\n", "\n\n", "  ", " ", "\t", "é", "É.", "ñ,", " ", "　", "\u0085", "漢字", "12", " 3", "!?", "<|endoftext|>", "_x", "\r\n", "ß", "×", "🙂"]
    rows = ["".join(r.choice(bits) for _ in range(r.randint(0, 60))) for _ in range(2000)] + ["word, " * 400_000, "y" * 1_100_000]
    special, around = "<|endoftext|>", ["word", " ", "\n", "é", "'s", "  x", ".", "", "<|endoftext|", "<|", "3"]
    rows += [a + special + b for a in around for b in around] + ["<|endof", "text|>", special, special * 3, "x" + special.upper()]
    cut = token_files.PIECE  # long texts are encoded in parts of so many bytes
    rows += [("a b, " * (cut // 5 + 1))[: cut - k] + special + " tail " * 9 for k in range(0, 16, 3)] + ["z" * (cut - 5) + special + "q" * 70_000 + special]
    library = Tokenizer.from_file(tokenizer_path())
    for _ in range(2):
        data, offsets = texts(pa.array(rows))
        ids, sizes = zip(*(encoder.encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in slices(offsets)), strict=True)
        ids, ends = np.concatenate(ids), np.cumsum(np.concatenate(sizes))
        for text, e, n in zip(rows, ends, np.concatenate(sizes), strict=True):
            assert ids[e - n : e].tolist() == library.encode(text, add_special_tokens=False).ids


def test_token_files(spark):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    rows = [(i * 7 % 101, f"text number {i} " * (i % 9), "s") for i in range(101)] + [(500, None, "s"), (None, "first", "s"), (500, "x", "s")]
    got = token_files.round_trip(documents(spark, rows), tokenizer_path(), token_files.TokenFileParams(block_ids=100), ids=True).collect()
    at = 0
    want = {}
    for i, t, _ in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        want[at] = (i, len(ids) // 4, zlib.crc32(ids), ids)
        at += len(ids) // 4
    assert {x.start: (x.doc_id, x.n_tokens, x.ids_crc32, bytes(x.ids)) for x in got} == want
    assert token_files.round_trip(documents(spark, []), tokenizer_path()).collect() == []
    assert token_files.round_trip(odd(spark), tokenizer_path()).count() == len(ODD) + 3


# --- mixing ---------------------------------------------------------------------------------------------------------


def wanted_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, open_, left = dict.fromkeys(names, 0.0), set(names), 1.5 * sum(sizes.values())
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        part = {s: left * weight[s] / total for s in open_}
        left = 0.0
        for s in list(open_):
            target[s] += part[s]
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                open_.discard(s)
    return target


@pytest.mark.parametrize("seed", [1, 2])
def test_mixing(spark, seed):
    r = random.Random(seed)
    rows = [(i, " ".join(["w"] * int(r.expovariate(0.02))), r.choice(["a", "a", "a", "b", "é", "Z", None])) for i in range(3000)]
    rows += [(5000, None, "a"), (5001, "", "only empty"), (5002, "p q", "a"), (5002, "p q", "a")]
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    docs = documents(spark, rows)
    got = mix(docs).collect()
    assert len(got) == len(rows)
    assert Counter((x.doc_id, x.taken) for x in got) == Counter((x.doc_id, x.taken) for x in mix(docs.repartition(7)).collect())
    target, taken = wanted_targets(sizes), Counter()
    for x in got:
        assert x.source_size == sizes[x.source] and math.isclose(x.target, target[x.source], abs_tol=1e-6) and 0 <= x.taken <= 2 * x.size
        taken[x.source] += x.taken
    for s, t in target.items():
        assert t - 60 <= taken[s] <= t + 1e-6
    out = mixed(docs)
    assert out.columns == docs.columns
    assert Counter(x.doc_id for x in out.collect())[0] == next(x.copies for x in got if x.doc_id == 0)


def test_mixing_prefers_quality(spark):
    rows = [(i, "word " * 10, "a" if i % 2 else "b") for i in range(4000)]
    docs = documents(spark, rows)
    got = mix(docs, F.when(F.col("doc_id") < 1000, 5.0).otherwise(1.0), share=0.3, cap=1.0).collect()
    assert sum(x.taken for x in got if x.doc_id < 1000) > 0.4 * sum(x.taken for x in got)
    assert mix(documents(spark, [])).collect() == []
    assert mix(odd(spark)).count() == len(ODD) + 3


# --- WARC -----------------------------------------------------------------------------------------------------------


def test_warc(spark):
    r = random.Random(3)
    same = "<p>" + "same " * 500
    rows = [(i, f"http://x/{i} y\r\n", r.choice([same, same, f"page {i} " * r.randint(0, 400), None, ""])) for i in range(200)]
    rows += [(999, None, "".join(chr(r.randint(32, 4000)) for _ in range(300_000))), (1000, "u", "unique"), (1000, "u", "unique"), (None, "u", "null id")]
    pages = spark.createDataFrame([(*x, "n", 1) for x in rows], "page_id long, url string, html string, sha1 string, n int").repartition(3)
    last = {}
    for i, _, html in rows:
        last[html or ""] = max(last.get(html or "", -1), -1 if i is None else i)
    want = Counter()
    for i, _, html in rows:
        body = (html or "").encode()
        first = None if last[html or ""] in (i, -1) else last[html or ""]
        want[i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if first is None else "revisit", first] += 1
    p = warc.WarcParams(split_bytes=700)
    got = warc.round_trip(spark, pages, p).collect()
    assert Counter((x.page_id, x.payload_bytes, x.payload_digest, x.record_type, x.refers_to) for x in got) == want
    bodies = {i: (h or "").encode() for i, _, h in rows}
    assert all(bytes(x.payload) == bodies[x.page_id] for x in got if x.record_type == "response")
    archives = warc.write_warc(pages, place(spark, "warc"), warc.WarcParams(revisit_bytes=100))
    assert all(x.record_type == "response" for x in warc.read_warc(archives).collect() if x.payload_bytes < 100)
    assert warc.round_trip(spark, pages.limit(0)).collect() == []


def test_false_magic_is_no_member():
    record = warc._record(1, "u", b"\x1f\x8b\x08" * 50, "D", None, warc.WarcParams())
    gz = zlib.compressobj(0, zlib.DEFLATED, 31)  # stored, so that the payload's magic stays in the archive
    data = gz.compress(record) + gz.flush()

    class File:
        at = 0

        def seek(self, at):
            self.at = at

        def read(self, n):
            return data[self.at : self.at + n]

    found = [m for a in range(0, len(data), 64) for m in warc._members(warc._Range(File(), len(data)), a, min(len(data), a + 64))]
    assert found == [record]


# --- decontamination ------------------------------------------------------------------------------------------------

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def test_decontamination(spark):
    r = random.Random(4)
    vocab = ["a", "b", "c", "dé", "E"]
    text = lambda n: r.choice([" ", ", ", "\n"]).join(r.choice(vocab) for _ in range(n))
    items = [(i, text(r.choice([3, 7, 10, 12, 25]))) for i in range(12)] + [(20, None), (21, ""), (22, "Zebra!"), (3, "one more text of item three that is long enough to be used"), (None, text(10))]
    rows = [(i, text(r.randint(0, 700)), "s") for i in range(60)]
    rows += [(100 + i, text(30) + " " + items[i][1].upper().replace("É", "é") + " " + text(30), "s") for i in range(12)]
    rows += [(200, None, "s"), (201, "", "s"), (202, "a zebra", "s"), (203, text(400_000), "s"), (202, "a zebra", "s")]
    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        m = min(10, len(w))
        for k in range(len(w) - m + 1 if m and i is not None else 0):
            windows[tuple(w[k : k + m])].add(i)
    lengths = {len(w) for w in windows}
    want = Counter()
    for i, t, _ in rows:
        w, hit, seen = words(t), set(), set()
        for m in lengths:
            for k in range(len(w) - m + 1):
                if found := windows.get(tuple(w[k : k + m])):
                    hit.update(range(k, k + m))
                    seen |= found
        want[i, len(w), len(hit), tuple(sorted(seen)), bool(hit)] += 1
    docs = documents(spark, rows)
    bench = spark.createDataFrame([(*x, "r") for x in items], "item_id long, text string, row string")
    for p in (DecontaminationParams(), DecontaminationParams(window_bytes=4000)):
        got = find_benchmark(docs, bench, p).collect()
        assert Counter((x.doc_id, x.n_words, x.n_hit, tuple(x["items"]), x.contaminated) for x in got) == want
        assert all(sum(s.end - s.begin for s in x.spans) == x.n_hit for x in got)
    parts = decontaminate._parts(bench, DecontaminationParams(window_bytes=4000))
    assert len(parts) > 2
    kept = without_benchmark(docs, bench)
    assert kept.columns == docs.columns and {x.doc_id for x in kept.collect()} == {k[0] for k in want if not k[4]}
    assert {x.doc_id for x in without_benchmark(docs, bench, DecontaminationParams(window_bytes=4000)).collect()} == {k[0] for k in want if not k[4]}
    twice = documents(spark, [(None, "a zebra", "s"), (None, "clean", "s"), (1, "zebra", "s"), (1, "clean", "s"), (1, None, "s"), (None, "", "s")])
    assert Counter((x.doc_id, x.text) for x in without_benchmark(twice, bench.filter("item_id = 22")).collect()) == Counter([(None, "clean"), (1, "clean"), (1, None), (None, "")])
    assert not any(x.contaminated for x in find_benchmark(docs, bench.limit(0)).collect())
    assert find_benchmark(documents(spark, []), bench).collect() == []


def test_passes_hold_one_part(spark, monkeypatch):
    """With ten parts no stage has the windows of more than one, and the driver makes a part's after the one before is gone."""
    bench = spark.createDataFrame([(i, f"item {i} " * 12) for i in range(400)], "item_id long, text string")
    docs = documents(spark, [(i, "x " + f"item {i} " * 15, "s") for i in range(390, 420)])
    p = DecontaminationParams(window_bytes=-(-sum(len(x.text) + decontaminate._WORD_BYTES * 24 for x in bench.collect()) // 10))
    made, alive, build = [], [], decontaminate._windows

    def watched(*args):
        gc.collect()
        alive.append(sum(w() is not None for w in made))
        out = build(*args)
        made.extend(map(weakref.ref, out))
        return out

    monkeypatch.setattr(decontaminate, "_windows", watched)
    found, kept = find_benchmark(docs, bench, p), without_benchmark(docs, bench, p)
    assert len(alive) == 20 and max(alive) <= 1  # the variable of the pass before, at most
    assert {x.doc_id for x in found.collect() if not x.contaminated} == {x.doc_id for x in kept.collect()} == set(range(400, 420))
    for df in (found, kept):
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("ArrowEvalPython") == 0 and plan.count("MapInArrow") <= 1  # the uniting of spans


@pytest.mark.parametrize("items", [1, 2000])
def test_windows_fit_their_estimate(items):
    r = random.Random(11)
    rows = [(i, " ".join(str(r.randrange(10**6)) for _ in range(200_000 // items))) for i in range(items)]
    windows = decontaminate._windows(rows, 10)
    assert sum(len(w.starts) for w in windows) == items * (200_000 // items - 9)
    assert len(pickle.dumps(windows)) <= decontaminate._WORD_BYTES * 200_000 + sum(len(t) + 1 for _, t in rows) + 10_000


# --- chat -----------------------------------------------------------------------------------------------------------


def test_chat(spark):
    nasty = ["<|im_end|>", "<\\|im_end|>", "\\", "<|", "<", "|", "\\\\<|im_sep|>", "", None, "<|im_end|><|im_start|>assistant ok", "a\nb", "é🙂", "<\\n|"]
    r = random.Random(5)
    rows = [(c, t, r.choice(["user", "assistant", "system\nx", "<|im_end|>", None]), r.choice(nasty)) for c in range(40) for t in range(r.randint(1, 9))]
    rows += [(0, 0, "user", "tie"), (0, 0, "user", "tie"), (None, None, "assistant", "no id"), (77, 1, "assistant", "long " * 300_000)]
    turns = spark.createDataFrame([(*x, "f", [1]) for x in rows], "conv_id long, turn long, role string, text string, formatted string, first array<int>")
    out = chat.format_chats(turns).withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("loss", chat.read_loss(F.col("formatted"), F.col("loss_spans")))
    groups = defaultdict(list)
    for c, t, role, text in rows:
        groups[c].append((t is not None, t or 0, role or "", text or ""))
    got = {x.conv_id: x for x in out.collect()}
    assert set(got) == set(groups)
    for c, g in groups.items():
        g.sort()
        assert [(x.role, x.text) for x in got[c].turns] == [(x[2], x[3]) for x in g]
        assert got[c].loss == "".join(x[3] for x in g if x[2] == "assistant")
        assert got[c].n_merged == sum(1 for a, b in zip([None, *g], g, strict=False) if a is None or a[2] != b[2])
    assert chat.format_chats(turns.limit(0)).collect() == []


# --- classifiers ----------------------------------------------------------------------------------------------------


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_language(spark):
    r = random.Random(6)
    lexicon = {"en": "the and of with that have this from they will", "de": "der und die nicht das mit von auch sich auf", "fr": "les des une dans pour pas que qui sur avec"}
    rows = []
    for i in range(300):
        lang = r.choice(list(lexicon))
        rows.append((i, " ".join(r.choice(lexicon[lang].split()) for _ in range(r.randint(3, 60))), lang))
    rows += [(1000 + i, t, "en") for i, t in enumerate([None, "", "123 !!", "漢字", "the " * 500_000])] + [(2000, "the and of", None)]
    docs = spark.createDataFrame([(*x, "s", 0.5) for x in rows], "doc_id long, text string, lang string, source string, score double")
    got = {x.doc_id: x for x in langid.predict(docs, langid.fit(docs)).collect()}
    assert len(got) == len(rows)
    out = [i for i, _, _ in rows[:300] if held_out(i)]
    assert np.mean([got[i].lang_pred == rows[i][2] for i in out]) > 0.95 and all(got[i].held_out for i in out)
    assert [got[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3 and got[1003].lang_pred != "und" and got[1004].lang_pred == "en"
    assert all(0 <= x.score <= 1 for x in got.values())
    none = langid.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {x.lang_pred for x in langid.predict(docs, none).collect()} == {"und"}
    assert langid.predict(docs.limit(0), none).collect() == []


def test_sample_is_bounded_and_repeatable(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 100 == 0, "rare").otherwise("common").alias("label"))
    a = bounded_sample(rows, "label", ["doc_id"], 400)
    assert a == bounded_sample(rows.repartition(9), "label", ["doc_id"], 400)
    assert Counter(x["label"] for x in a) == {"rare": 50, "common": 200}


def labelled(spark, seed, make, column):
    r = random.Random(seed)
    plain = "time house water light stone river green night bread paper".split()
    rows, labels = [], []
    for i in range(500):
        y = int(r.random() < 0.3)
        rows.append((i, make(r, y, [r.choice(plain) for _ in range(r.randint(15, 80))]), "s"))
        labels.append((i, y))
    rows += [(9000 + i, t, "s") for i, t in enumerate(ODD)]
    return documents(spark, rows), spark.createDataFrame([*labels, (9000, None), (9001, 7)], f"doc_id long, {column} int"), dict(labels)


def check(got, labels):
    assert all(0 <= x.score <= 1 for x in got) and len(got) == 500 + len(ODD)
    out = [x for x in got if x.doc_id < 9000 and x.held_out]
    assert out and all(x.held_out == held_out(x.doc_id) for x in got)
    assert np.mean([x.predicted == labels[x.doc_id] for x in out]) > 0.95


def test_toxicity(spark):
    def make(r, y, w):
        if y:
            w.insert(r.randrange(len(w)), "you are a " + r.choice(["moron", "frobnak", "zugbert"]))
        elif r.random() < 0.3:
            w.insert(r.randrange(len(w)), r.choice(["he said that nothing", "it is not you"]))
        return " ".join(w) + "."

    docs, labels, known = labelled(spark, 7, make, "toxic")
    got = toxicity.classify(docs, labels).collect()
    check(got, known)
    assert all(x.predicted == int(x.score >= 0.5) for x in got)
    one = toxicity.classify(docs, labels.filter("toxic = 0")).collect()
    assert all(x.predicted == 0 for x in one) and toxicity.classify(docs.limit(0), labels).collect() == []


def test_grammar():
    machine = toxicity.grammar()

    def kinds(*symbols):
        state, out = 0, []
        for s in symbols:
            state, kind, weight = machine.step(state, s)
            out.append((kind, round(weight, 3)))
        return out

    o, i, t, y, n, q, e = toxicity.OTHER, toxicity.INSULT, toxicity.THREAT, toxicity.TARGET, toxicity.NEGATION, toxicity.REPORT, toxicity.END
    assert kinds(i)[-1] == (toxicity.INSULT, 0.0)
    assert kinds(y, o, i)[-1] == (toxicity.AIMED, 0.4)
    assert kinds(n, o, i)[-1] == (toxicity.DENIED, -1.0)
    assert kinds(n, o, o, o, i)[-1] == (toxicity.INSULT, 0.0)
    assert kinds(q, y, i)[-1] == (toxicity.QUOTED, -0.7)
    assert kinds(q, e, i)[-1] == (toxicity.INSULT, 0.0)
    assert kinds(t, y)[-1] == (toxicity.THREAT, 0.0)
    assert kinds(t, o, y)[-1] == (toxicity.TARGET, 0.0)


def test_quality(spark):
    def make(r, y, w):
        return (" ".join(w).capitalize() + ".") if y else r.choice([" ".join(x + "###" for x in w), " ".join(w[:2] * 40), "!! ".join(w).upper()])

    docs, labels, known = labelled(spark, 8, make, "quality")
    got = quality.classify(docs, labels).collect()
    check(got, known)
    assert all(x.predicted == int(x.score >= 0.3) for x in got)
    kept = quality.good(docs, labels)
    assert kept.columns == docs.columns and {x.doc_id for x in kept.collect()} == {x.doc_id for x in got if x.predicted}
    bad = next(x.text for x in docs.collect() if x.text and "###" in x.text)
    fine = next(x.text for x in docs.collect() if x.doc_id in known and known[x.doc_id])
    twice = docs.unionByName(documents(spark, [(None, bad, "s"), (None, fine, "s"), (7777, bad, "s"), (7777, fine, "s"), (7777, fine, "s")]))
    kept = Counter((x.doc_id, x.text) for x in quality.good(twice, labels).collect() if x.doc_id in (None, 7777))
    assert kept == Counter({(None, fine): 1, (7777, fine): 2})
    assert {round(x.score, 6) for x in quality.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(docs.limit(0), labels).collect() == []


# --- parts ----------------------------------------------------------------------------------------------------------


def test_components(spark):
    r = random.Random(9)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5), (2000, 3000)] + [(7, x) for x in range(500, 560)]
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = components(spark.createDataFrame(edges, "u long, v long"))
    assert {x.node: x.root for x in got.collect()} == {k: v for k, v in label.items() if any(k in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_words_of_kernel():
    hasher, r = WordHasher(), random.Random(10)
    rows = ["".join(r.choice("abAB é.,_0\n") for _ in range(r.randint(0, 40))) for _ in range(500)] + [None, "w " * 800_000]
    data, offsets = texts(pa.array(rows, pa.string()))
    known = {}
    for a, b in slices(offsets):
        part = data[offsets[a] : offsets[b]]
        hashes, begin, end, at = hasher.words(part, offsets[a : b + 1] - offsets[a])
        for i in range(a, b):
            want = words(rows[i])
            assert at[i - a + 1] - at[i - a] == len(want)
            for h, w in zip(hashes[at[i - a] : at[i - a + 1]].tolist(), want, strict=True):
                assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)
