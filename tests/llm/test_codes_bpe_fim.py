"""Vector codes, byte-pair encoding and fill-in-middle against plain versions; nulls, long texts, ties, repeats, empty tables."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelmill.llm import bpe, fim, vector_codes
from panelmill.llm.queries import tokenizer_path

# --- vector codes ----------------------------------------------------------------------------------------------------


def plain_codes(rows, parts, entries, rounds):
    """Codes and errors of whole vectors by comparing with every entry, in Python integers; and the codebooks."""
    kept = [(i, [math.floor(4096 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0]))
    d = len(kept[0][1]) // parts
    cut = [[v[p * d : (p + 1) * d] for p in range(parts)] for _, v in kept]
    books = [[x[p] for x in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for x in cut:
                groups.setdefault(nearest(x[p], books[p])[1], []).append(x[p])
            books[p] = [[sum(c) // len(c) for c in zip(*groups[j], strict=True)] if j in groups else e for j, e in enumerate(books[p])]
    found = [[nearest(x[p], books[p]) for p in range(parts)] for x in cut]
    return [(i, "".join("%02x" % j for _, j in f), sum(e for e, _ in f)) for (i, _), f in zip(kept, found, strict=True)], books


def test_vector_codes_equal_plain(spark):
    r = random.Random(3)
    centres = [[r.gauss(0, 1) for _ in range(12)] for _ in range(5)]
    rows = [(i, [float(np.float32(c + r.gauss(0, 0.1))) for c in r.choice(centres)]) for i in range(300)]
    rows[3], rows[7], rows[11] = (3, None), (7, [float("nan")] + rows[7][1][1:]), (11, rows[11][1][:-1] + [float("inf")])
    rows[13] = (13, [None] + rows[13][1][1:])
    rows += [(400 + i, rows[20][1]) for i in range(30)] + [(21, rows[21][1]), (None, rows[22][1])]
    labels = [None, 1, 2, 2, 2]
    table = [(i, v, labels[(i or 0) % 5], "x") for i, v in rows]
    df = spark.createDataFrame(table, "vec_id long, embedding array<float>, label int, code string")  # clashes with the result's code
    p = vector_codes.CodeParams(parts=4, entries=6, rounds=3)
    got = vector_codes.compress(df, p).collect()
    want, books = plain_codes(rows, 4, 6, 3)
    assert sorted(map(str, ((x.vec_id, x.code, x.error) for x in got))) == sorted(map(str, want))
    sums = {}
    for i, _, e in want:
        sums[labels[(i or 0) % 5]] = sums.get(labels[(i or 0) % 5], 0) + e
    assert all(x.label_error == sums[labels[(x.vec_id or 0) % 5]] for x in got)
    flat = ",".join(str(c) for b in books for e in b for c in e)
    assert {x.codebooks_sha256 for x in got} == {hashlib.sha256(flat.encode()).hexdigest()}


def test_equal_average_search_keeps_ties():
    r = np.random.default_rng(5)
    entries = r.integers(-3, 4, (1, 40, 3))  # small numbers: many entries at equal distance, and equal sums
    books = vector_codes.Codebooks(entries.astype(np.int64), 1)
    x = r.integers(-4, 5, (500, 3)).astype(np.int64)
    which, best = books.nearest(0, x)
    every = ((x[:, None] - entries[0][None]) ** 2).sum(axis=2)
    assert (best == every.min(axis=1)).all() and (which == every.argmin(axis=1)).all()


def test_vector_codes_odd_rows(spark):
    schema = "vec_id long, embedding array<double>, label int"
    assert vector_codes.compress(spark.createDataFrame([], schema)).count() == 0
    nothing = spark.createDataFrame([(1, None, 1), (2, [math.nan] * 8, 1)], schema)
    assert vector_codes.compress(nothing).count() == 0
    few = spark.createDataFrame([(1, [1.0] * 8, 1), (2, [2.0] * 8, None), (3, [1.0] * 16, 1), (4, [1e300] + [0.0] * 7, 1), (5, [], 2)], schema)
    got = {x.vec_id: x for x in vector_codes.compress(few).collect()}
    assert set(got) == {1, 2, 3, 4, 5} and got[3].code is None and got[3].error is None and got[5].code is None
    assert got[1].error == 0 and got[2].label_error == got[2].error == 0
    books = vector_codes.fit(few)
    back = {x.vec_id: x.vector for x in vector_codes.decode(vector_codes.encode(few, books), books).collect()}
    assert back[1] == [1.0] * 8 and back[3] is None
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.compress(spark.createDataFrame([(1, [1.0] * 9, 1)], schema))


# --- byte-pair encoding ----------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    out.no_padding()
    out.no_truncation()
    return out


@pytest.fixture(scope="module")
def encoder():
    return bpe.WordEncoder(tokenizer_path("word_bpe_49k.json"), bpe.BpeParams(remembered=2000, symbols=500))


def ids_of(encoder, text):
    data = np.frombuffer(text.encode(), np.uint8)
    return encoder.encode(data, np.array([0, len(data)]))[0].tolist()


ODD = [
    "", " ", "\n\t ", "'s 't 're 've 'm 'll 'd 'S don't 'tis ''s '", "<|endoftext|>", "a<|startoftext|>b<|ENDOFTEXT|>", "<|endoftext|><|endoftext|>",
    "é ño ≠a ≮", " x　y z\x85w\x1cv", "İSTANBUL Straße ΣΑΣ ſ K", "한글 漢字かな 😀👍🏽 ½ ² १२३", "a1b22c-3.14_x", "́a", "a‍b",
    "1́ 2⃣", "<|end oftext|>", "ＦＵＬＬ",
]


def test_bpe_equals_library_on_odd_texts(encoder, library):
    r = random.Random(7)
    bits = [*"abcdefghij ABC éßüñ'’-=.,!19\n\t", "́", " ", "漢", "한", "😀", "<|endoftext|>", "'s", "'ll", "the", "ing", "aaaa", "ation", "<|startoftext|>", "̸"]
    made = ["".join(r.choice(bits) for _ in range(r.randint(0, 40))) for _ in range(1500)]
    for text in ODD + made:
        assert ids_of(encoder, text) == library.encode(text, add_special_tokens=False).ids, repr(text)
    assert encoder.failed > 100 and encoder.words > encoder.failed + 100  # both ways were taken


@pytest.mark.parametrize("text", ["a" * 300_000, "ab" * 140_000 + " x", "".join(random.Random(1).choice("abcdefghéñ") for _ in range(280_000)), "word, " * 60_000])
def test_bpe_equals_library_on_long_texts(encoder, library, text):
    assert ids_of(encoder, text) == library.encode(text, add_special_tokens=False).ids


def test_pairs_stay_as_merging_has_them(encoder):
    """The vectorised check against merging the symbols of both tokens."""
    m, r = encoder.merges, random.Random(2)
    inner = [t for t in range(m.size) if m.lengths[t] and m.flat[m.begins[t] + m.lengths[t] - 1] < bpe.END]
    a, b = np.array(r.choices(inner, k=3000)), np.array(r.choices(range(m.size), k=3000))
    symbols = [m.flat[m.begins[t] : m.begins[t] + m.lengths[t]].tolist() for t in range(m.size)]
    assert m.stays(a, b).tolist() == [m.merged(symbols[x] + symbols[y]) == [x, y] for x, y in zip(a, b, strict=True)]
    assert all(m.merged(symbols[t]) == [t] for t in r.sample(range(m.size), 2000))


def test_merges_that_break_their_own_tokens():
    """A token that merging its own symbols doesn't give is never proposed: b,c comes before a+b makes ab, so abc is a, bc."""
    letters = list(bpe.byte_letters())
    vocab = {c: i for i, c in enumerate(letters)} | {c + "_": 256 + i for i, c in enumerate(letters)}
    merges = [("b", "c"), ("a", "b"), ("ab", "c"), ("bc", "d_"), ("a", "a")]
    for a, b in merges:
        vocab[a + b] = len(vocab)
    m = bpe.Merges(vocab, merges, "_")
    assert not m._is_own(vocab["abc"])
    for word in ("abcd", "abcabcd", "aaaa", "aaa", "abab", "bcd", "d", "aabcd"):
        symbols = np.array([ord(c) for c in word], np.int64)
        symbols[-1] += bpe.END
        ids, sizes, _ = m.encode(symbols, np.array([0, len(word)]))
        assert ids.tolist() == m.merged(symbols.tolist()) and sizes.tolist() == [len(ids)]


def test_bpe_tables(spark, library):
    path = tokenizer_path("word_bpe_49k.json")
    texts = [None, *ODD, "x" * 300_000, "The same", "The same"]
    rows = [(i if i != 4 else None, t, "z") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.decode(bpe.encode(docs, path), path).collect()
    want = []
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)))
    assert sorted(map(str, ((x.doc_id, x.n_tokens, bytes(x.ids), x.decoded) for x in got))) == sorted(map(str, want))
    assert bpe.encode(docs.limit(0), path).count() == 0
    odd = spark.createDataFrame([(None,), (b"",), (np.array([320, 99_999, 49407], "<u4").tobytes(),)], "ids binary")
    assert sorted(str(x.decoded) for x in bpe.decode(odd, path).collect()) == sorted(["None", "", library.decode([320, 49407], skip_special_tokens=False)])


# --- fill in the middle ----------------------------------------------------------------------------------------------


def plain_fim(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n, h = len(units), hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    parts = ["".join(x) for x in (units[:a], units[a:b], units[b:])]
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(parts[0]), len(parts[1]), f"<S>{parts[2]}<P>{parts[0]}<M>{parts[1]}"
    return n, "psm", len(parts[0]), len(parts[1]), f"<P>{parts[0]}<S>{parts[2]}<M>{parts[1]}"


def fim_rows():
    r = random.Random(9)
    bits = ["word", "Ab", " ", "\n", "é", "漢", "😀", "<", ">", "P", "S", "M", "<P", "P>", "<S", "1", "́"]
    rows = [(i, "".join(r.choice(bits) for _ in range(r.randint(0, 60)))) for i in range(400)]
    rows += [(500 + i, "word é\n" * 3000) for i in range(8)] + [(600, None), (601, ""), (602, "<M>"), (603, "x" * 200_000), (None, "no id"), (None, None)]
    rows += [(700, "twice"), (700, "twice"), (700, "other"), (7, rows[7][1])]
    return rows


@pytest.mark.parametrize("units", [7, 1 << 16])
def test_fim_equals_plain(spark, units):
    rows = fim_rows()
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, form string").repartition(5)
    got = fim.round_trip(docs, fim.FimParams(chunk_units=units)).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for i, t in rows:
        n, form, prefix, middle, out = plain_fim(i, t)
        want.append((i, n, form, prefix, middle, sha(out), sha(t or "")))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert {x.form for x in got} == {"plain", "psm", "spm"}
    texts = {(x.doc_id, x.form, x.text) for x in fim.transform(docs).collect()}
    assert texts == {(i, plain_fim(i, t)[1], plain_fim(i, t)[4]) for i, t in rows}
    for i, t in rows:
        assert fim.restore(plain_fim(i, t)[1], plain_fim(i, t)[4]) == (t or "")


def test_fim_cuts_outputs_anywhere():
    """Sentinels are found wherever pieces of an output end."""
    text = "a<b P>c<S d"
    for form, output in (("psm", "<P>a<<S> P>c<S d<M>b"), ("spm", "<S><S d<P>a<<M>b P>c"), ("psm", "<P><S><M>"), ("plain", text)):
        raw = output.encode()
        for size in range(1, len(raw) + 1):
            cut = list(fim.sections(form, [raw[i : i + size] for i in range(0, len(raw), size)]))
            joined = [b"".join(x for r, x in cut if r == rank) for rank in range(3)]
            whole = list(fim.sections(form, [raw]))
            assert joined == [b"".join(x for r, x in whole if r == rank) for rank in range(3)]


def test_fim_shuffles_once(spark):
    """The second sort keeps the first one's partitions; an empty table is empty."""
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert fim.round_trip(docs).count() == 0
    cut = spark.sparkContext.parallelize([(((b"12345678", 0, 0), 0), b"x")], 2).repartitionAndSortWithinPartitions(3, fim._place)
    again = cut.mapPartitions(lambda x: x, preservesPartitioning=True).repartitionAndSortWithinPartitions(3, fim._place)
    assert again.toDebugString().decode().count("ShuffledRDD") == 1


def test_new_queries_over_documents(spark, library):
    """The registered queries over the smallest tables: the encoder's against the library, decoding included."""
    from panelmill.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = {x.doc_id: x.text or "" for x in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("text")).collect()}
    got = QUERIES["op12_bpe"](spark, sf).collect()
    assert len(got) == len(docs)
    for x in got:
        ids = library.encode(docs[x.doc_id], add_special_tokens=False).ids
        assert (x.n_tokens, x.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert x.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
