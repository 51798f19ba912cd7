"""Classifiers and sampling against plain versions: an explicit kernel matrix, a scorer word by word, a textbook discriminant, a sort."""

import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa

from panelmill.llm import langid, quality, toxicity
from panelmill.llm.mixing import mix
from panelmill.llm.sampling import bounded_sample
from panelmill.llm.textkernel import WordHasher, texts

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())


# --- language: kernel ridge regression on the kernel matrix itself -------------------------------------------------


def grams(text, p):
    """The numbers of a text's n-grams, by n, from sets of bytes."""
    seen = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in low(text))
    out = []
    for k, bits in enumerate(p.bits):
        codes = {sum(seen[i + j] << (8 * j) for j in range(k + 1)) for i in range(len(seen) - k)}
        out.append({((c * 0x9E3779B1) & 0xFFFFFFFF) >> (32 - bits) for c in codes})
    return out


def kernel(a, b):
    parts = [len(x & y) / math.sqrt(max(1, len(x)) * max(1, len(y))) for x, y in zip(a, b, strict=True)]
    return sum(parts) / len(parts)


def test_language_equals_kernel_matrix(spark):
    r = random.Random(1)
    lexicon = {"en": "the and of with that", "de": "der und nicht das für", "fr": "les des été dans pour"}
    rows = [(i, " ".join(r.choice(lexicon[x].split()) for _ in range(r.randint(2, 12))), x) for i in range(150) for x in [r.choice(list(lexicon))]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    p = langid.LanguageParams(sample_rows=60, landmarks=12)
    got = {x.doc_id: x for x in langid.predict(docs, langid.fit(docs, p)).collect()}
    known = docs.filter("crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0")
    sample = bounded_sample(known, "lang", ["text"], p.sample_rows)
    # the sample's order among equal hashes doesn't matter here, as all texts differ in their hash
    sets, labels = [grams(x["text"], p) for x in sample], sorted(lexicon)
    marks = sets[:: max(1, -(-len(sets) // p.landmarks))]
    inner = np.array([[kernel(a, b) for b in marks] for a in marks])
    values, vectors = np.linalg.eigh(inner)
    good = values > 1e-8 * values[-1]
    root = vectors[:, good] / np.sqrt(values[good])
    mapped = np.array([[kernel(a, b) for b in marks] for a in sets]) @ root
    y = np.array([[float(x["lang"] == label) for label in labels] for x in sample])
    mean = y.mean(axis=0)
    solved = np.linalg.solve(mapped.T @ mapped + p.ridge * len(sets) * np.eye(mapped.shape[1]), mapped.T @ (y - mean))
    for i, text, _ in rows:
        values = np.array([kernel(grams(text, p), m) for m in marks]) @ root @ solved + mean
        assert got[i].lang_pred == labels[int(values.argmax())]
        assert math.isclose(got[i].score, min(1.0, max(0.0, values.max())), abs_tol=2e-4)


# --- toxicity: word by word ------------------------------------------------------------------------------------------


def symbols(word, learned):
    for symbol, words in toxicity._WORDS.items():
        if word in [w.encode() for w in words.split()]:
            return symbol, learned.get(word, 1.0) if symbol == toxicity.INSULT else 1.0
    return (toxicity.INSULT, learned[word]) if word in learned else (toxicity.OTHER, 1.0)


def plain_features(text, learned):
    """Features from lists of words by clause, with the three rules as loops."""
    kinds = dict.fromkeys(toxicity._KINDS, 0.0)
    largest, matched, total = 0.0, 0, 0
    for clause in re.split(rb"[.!?;\n]", low(text)):
        denied, report, person, found = 0, False, 0, dict.fromkeys(toxicity._KINDS, 0.0)
        words = WORD.findall(clause)
        total += len(words)
        tagged = [symbols(w, learned) for w in words]
        threat = False
        for symbol, weight in tagged:
            out, log = symbol, 0.0
            if symbol == toxicity.NEGATION:
                denied = 3
            elif denied and symbol in (toxicity.OTHER, toxicity.TARGET, toxicity.REPORT):
                denied -= 1
            elif denied and symbol == toxicity.INSULT:
                out, log, denied = toxicity.DENIED, -1.0, 0
            elif denied and symbol == toxicity.THREAT:
                out, denied = toxicity.OTHER, 0
            if report and out in (toxicity.INSULT, toxicity.DENIED):
                out, log = toxicity.QUOTED, log - 0.7
            elif report and out == toxicity.THREAT:
                out = toxicity.OTHER
            report |= symbol == toxicity.REPORT
            if threat:
                if out == toxicity.TARGET:
                    out, threat, person = toxicity.THREAT, False, 4
                elif out == toxicity.THREAT:
                    out = toxicity.OTHER
                else:
                    threat, person = False, 0
            elif out == toxicity.TARGET:
                person = 4
            elif out == toxicity.THREAT:
                out, threat = toxicity.OTHER, True
            elif person and out == toxicity.INSULT:
                out, log = toxicity.AIMED, log + 0.4
            elif person:
                person -= 1
            if out in found:
                found[out] += (weight if symbol == toxicity.INSULT else 1.0) * math.exp(log)
        for k in kinds:
            kinds[k] += found[k]
        if any(found.values()):
            matched, largest = matched + 1, max(largest, *found.values())
    return [*(math.log1p(kinds[k]) for k in toxicity._KINDS), largest, math.log1p(matched), math.log1p(100 * matched / max(total, 20))]


def test_toxicity_equals_word_by_word(spark):
    r = random.Random(2)
    pool = [w for words in toxicity._WORDS.values() for w in words.split()] + ["house", "river", "stone", "frobnak", "You", "IDIOT"] * 8
    rows, labels = [], []
    for i in range(400):
        y = int(r.random() < 0.4)
        words = [r.choice(pool) for _ in range(r.randint(0, 40))] + (["frobnak", "you"] if y else [])
        rows.append((i, "".join(w + r.choice([" ", " ", " ", ", ", ". ", "! ", "\n"]) for w in words)))
        labels.append((i, y))
    rows += [(900, None), (901, "")]
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, known)
    names = {toxicity.word_key(w): w.encode() for w in {x.lower() for x in pool}}
    fixed = {toxicity.word_key(w): s for s, words in toxicity._WORDS.items() for w in words.split()}
    learned = {names[int(k)]: w for k, s, w in zip(model.lexicon.keys, model.lexicon.symbols, model.lexicon.weights, strict=True) if s == toxicity.INSULT and int(k) in names}
    for k, s in zip(model.lexicon.keys.tolist(), model.lexicon.symbols.tolist(), strict=True):
        assert fixed.get(k, toxicity.INSULT) == s  # a word of the grammar stays what it is
    # counted plainly, the words that toxic rows have far more often
    teach = [(t, y) for (i, t), (_, y) in zip(rows, labels, strict=False) if zlib.crc32(str(i).encode()) % 5]
    n = [sum(y == c for _, y in teach) for c in (0, 1)]
    want = {}
    for word in {w for t, _ in teach for w in WORD.findall(low(t))}:
        a, b = (sum(word in WORD.findall(low(t)) for t, y in teach if y == c) for c in (1, 0))
        odds = math.log((a + 0.5) / (n[1] + 1)) - math.log((b + 0.5) / (n[0] + 1))
        if a >= 4 and odds >= 2:
            want[word] = min(3.0, odds)
    for word, odds in want.items():
        if fixed.get(toxicity.word_key(word.decode()), toxicity.INSULT) == toxicity.INSULT:
            assert math.isclose(learned[word], odds, rel_tol=1e-9)
    got = {x.doc_id: x.score for x in toxicity.score(docs, model).collect()}
    for i, text in rows:
        z = np.dot(plain_features(text, learned), model.weights) + model.bias
        assert math.isclose(got[i], 1 / (1 + math.exp(-z)), rel_tol=1e-6, abs_tol=1e-9)


def test_end_leads_every_state_to_the_first():
    machine = toxicity.grammar()
    assert {machine.step(state, toxicity.END)[0] for state, _ in machine.steps} == {0}


# --- quality: the textbook's density -----------------------------------------------------------------------------------


def plain_statistics(text):
    """The statistics from Python's own counts."""
    data = (text or "").encode()
    logit = lambda x, f: math.log(x + f) - math.log(1 - x + f)
    out = [logit((sum(b in kind for b in data) + 60 * usual) / (len(data) + 60), 1e-3) for kind, usual in quality._KINDS.values()]
    words = WORD.findall(low(text))
    m, counts = len(words), defaultdict(int)
    for w in words:
        counts[w] += 1
    triples = [tuple(words[i : i + min(3, m)]) for i in range(max(1, m - 2))] if m else []
    out += [math.log(m + 12), math.log((sum(map(len, words)) + 72) / (m + 12))]
    if not m:
        return out + [0.3 * math.log(12), logit(0.08, 0.01), logit(1.0, 0.01), logit(0.7, 0.01)]
    return out + [
        math.log(len(counts) + 12) - 0.7 * math.log(m + 12), logit((max(counts.values()) + 0.08 * 12) / (m + 12), 0.01),
        logit((len(set(triples)) + 12) / (len(triples) + 12), 0.01), logit((sum(v == 1 for v in counts.values()) + 0.7 * 12) / (m + 12), 0.01),
    ]


def test_quality_equals_textbook(spark):
    r = random.Random(3)
    plain = "Time house, water light! stone river; 42 green été night".split()
    rows, labels = [], []
    for i in range(300):
        y = int(r.random() < 0.6)
        words = [r.choice(plain) for _ in range(r.randint(1, 60))]
        rows.append((i, " ".join(words) if y else "##".join(words[:3] * r.randint(1, 9)).upper()))
        labels.append((i, y))
    rows += [(900, None), (901, ""), (902, "x")]
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    got = {x.doc_id: x for x in quality.classify(docs, known).collect()}
    x, y = np.array([plain_statistics(t) for _, t in rows]), np.array([v for _, v in labels])
    teach = np.array([zlib.crc32(str(i).encode()) % 5 != 0 for i, _ in labels])
    p, logs = quality.QualityParams(), []
    classes = [x[: len(y)][teach & (y == c)] for c in (0, 1)]
    cov = [np.cov(z.T, bias=True) for z in classes]
    pooled = sum(len(z) * c for z, c in zip(classes, cov, strict=True)) / sum(map(len, classes))
    for z, c in zip(classes, cov, strict=True):
        s = (1 - p.pooled) * c + p.pooled * pooled
        s = (1 - p.identity) * s + p.identity * (np.trace(s) / len(s) + 1e-6) * np.eye(len(s))
        d = x - z.mean(axis=0)
        distance = np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d)
        logs.append(math.log((len(z) + 1) / (teach.sum() + 2)) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * distance)
    want = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))
    for (i, _), w in zip(rows, want, strict=True):
        assert math.isclose(got[i].score, w, rel_tol=1e-5, abs_tol=1e-7) and got[i].predicted == int(got[i].score >= 0.3)
    stay = {x.doc_id for x in quality.good(docs, known).collect()}
    assert stay == {i for i in got if got[i].predicted}


def test_learning_takes_one_worker_a_task(spark, monkeypatch):
    """No task pipes the rows of one Python worker into another one, which Spark would keep for all later tasks."""
    docs = spark.createDataFrame([(i, "some words here " * (1 + i % 3) + "#" * (i % 2)) for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(3, 0)], "doc_id long, quality int")
    kind, below = type(docs), []
    plain = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, *a, **b: (below.append(self._jdf.queryExecution().analyzed().toString()), plain(self, *a, **b))[1])
    quality.good(docs, labels).count()
    measured = quality.fit(quality.table(quality.statistics(docs), "statistics"), labels)
    assert len(below) >= 3 and not any("MapInArrow" in x for x in below)
    texts = quality.fit_texts(docs, labels)
    for a, b in ((texts.means, measured.means), (texts.inverses, measured.inverses), (texts.offsets, measured.offsets)):
        assert np.allclose(a, b)


# --- mixing: one sort ------------------------------------------------------------------------------------------------


def test_mixing_equals_sort(spark):
    r = random.Random(4)
    rows = [(i, " ".join(["word"] * int(r.expovariate(0.05))), r.choice("aaab")) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {x.doc_id: x for x in mix(docs).collect()}
    keys = docs.selectExpr("doc_id", "source", "(shiftrightunsigned(xxhash64(doc_id, 1), 11) + 0.5D) / 9007199254740992D as u").toPandas()
    for source in "ab":
        part = keys[keys.source == source]
        own = [got[i] for i in part.doc_id]
        target, size = own[0].target, sum(x.size for x in own)
        epochs = int(target // size)
        weight = np.array([1.0 if x.size else 0.0005 for x in own])  # plain words weigh 1, empty texts next to nothing
        order = pd.DataFrame({"key": -np.log(part.u.to_numpy()) / weight, "i": part.doc_id.to_numpy(), "size": [x.size for x in own]}).sort_values("key")
        rest = target - epochs * size
        before = order["size"].cumsum()
        taken = {x.doc_id for x in own if x.copies > epochs}
        sure = set(order.i[before <= rest])
        assert sure <= taken  # the sorted prefix that fits is taken whole
        width = 4096 * 2.7 / len(own)
        edge = np.floor(np.log(order.key[before > rest].iloc[0]) / min(1.0, width))
        assert all(np.floor(np.log(k) / min(1.0, width)) == edge for k in order.key[order.i.isin(taken - sure)])  # else only of the bucket that the target falls into
        assert sum(x.size for x in own if x.doc_id in taken) <= rest


def test_hasher_is_word_for_word():
    hashes = WordHasher().words(*texts(pa.array(["One one ONE two"])))[0].tolist()
    assert len({*hashes[:3]}) == 1 and hashes[3] != hashes[0]
