"""Spelling variants, embedding whitening and byte-level BPE against plain versions, on small tables with odd rows."""

import base64
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from tablestream.llm import bpe, merges, packing, queries, ragged, spelling, whitening

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["body", "ids", "word", "n", "x", "key", "d", "piece", "root"]


def table(spark, rows, schema=SCHEMA, clash=True):
    from pyspark.sql import functions as F
    d = spark.createDataFrame(rows, schema).repartition(3)
    return d.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)]) if clash else d


# ---- spelling variants ------------------------------------------------------------------------------------

def letter_texts(seed=0, n=150):
    r = random.Random(seed)
    stems = ["".join(r.choice("abcdeéßÀ") for _ in range(r.randrange(6, 10))) for _ in range(25)] + ["ababababab", "aaaaaaa", "aaaaaaaa"]

    def edit(w):
        i, c = r.randrange(len(w)), r.choice("abcdeéß")
        return r.choice([w[:i] + w[i + 1:], w[:i] + c + w[i:], w[:i] + c + w[i + 1:], w, w, w, w, w.upper()])
    texts = [" ".join(edit(stems[int(len(stems) * r.random() ** 3)]) for _ in range(r.randrange(1, 60))) + r.choice(["", ".", "1x", "\n"]) for _ in range(n)]
    return [None, "", "  ", "q" * 3000, "q" * 3000, "q" * 2999 + " Ÿ汉字", *texts]


def plain_words(rows):
    out = {}
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] = out.get(run, 0) + 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def plain_variants(words):
    where = {}
    for w in words:                                          # words one edit apart share a pattern with one letter out
        for i in range(len(w)):
            where.setdefault((w[:i], w[i + 1:]), set()).add(w)
        for i in range(len(w) + 1):
            where.setdefault((w[:i], w[i:]), set()).add(w)
    near = {w: set() for w in words}
    for group in where.values():
        for w in group:
            near[w] |= group - {w}

    def one(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))
    near = {w: {x for x in found if one(w, x)} for w, found in near.items()}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {(w, form[w], root(w), words[w], len(near[w]), words[form[w]] if form[w] else None) for w in words}


def test_corpus_words(spark):
    rows = [(i if i % 9 else None, t) for i, t in enumerate(letter_texts())]
    got = spelling.corpus_words(table(spark, [(d, t, None, None, None) for d, t in rows]))
    assert {r.word: r.n for r in got.collect()} == plain_words(rows)


@pytest.mark.parametrize("box", [20_000, 30, 4])
def test_spelling_variants(spark, box):
    """The same whether a length is one box or cut into many."""
    words = plain_words(list(enumerate(letter_texts(3, 400))))
    got = spelling.spelling_variants(spark.createDataFrame(list(words.items()), "word string, n long"), box_words=box).collect()
    assert len(got) == len(words) and {tuple(r) for r in got} == plain_variants(words)


def test_spelling_query_and_ties(spark, tmp_path):
    rows = [(i, t, None, None, None) for i, t in enumerate(letter_texts(5, 100))]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(r) for r in queries.QUERIES["op11_spelling_variants"](spark, str(tmp_path)).collect()}
    assert got == plain_variants(plain_words([r[:2] for r in rows]))
    words = [("abcdefg", 2), ("abcdefh", 20), ("abcdefi", 20), ("abcdefgg", 19), ("abcdefhh", 200), ("zbcdefg", 2), (None, 5), ("abcdefh", 3)]
    got = {r.word: r for r in spelling.spelling_variants(spark.createDataFrame(words, "word string, n long")).collect()}
    assert len(got) == 6 and got["abcdefg"].form == "abcdefh" and got["abcdefg"].root == "abcdefhh" and got["abcdefgg"].form is None
    assert got["abcdefg"].n_near == 4 and got["zbcdefg"].form is None
    assert spelling.spelling_variants(spark.createDataFrame([], "word string, n long")).collect() == []
    assert spelling.corpus_words(spark.createDataFrame([], SCHEMA)).collect() == []


def test_boxes_and_trees():
    r = random.Random(2)
    words = sorted({"".join(r.choice("abcdé") for _ in range(8)) for _ in range(600)})
    codes = spelling.count_bits(spelling.letters(words))
    top = spelling.KdTree(codes[::5], 8, whole_space=True)
    home = top.home(codes)
    reach = set(zip(*(x.tolist() for x in top.reach(codes, 2))))
    assert all((i, h) in reach for i, h in enumerate(home.tolist())) and len(set(home.tolist())) > 4
    counts = [sorted(w) for w in words]
    near = lambda a, b: sum(abs(a.count(c) - b.count(c)) for c in "abcdé") <= 2
    tree = spelling.KdTree(codes)
    got = {(x, y) for a, b in tree.candidates(codes, codes, 2) for x, y in zip(a.tolist(), b.tolist())}
    for i in range(0, len(words), 7):
        for j in range(len(words)):
            if near(counts[i], counts[j]):
                assert (i, j) in got and (i, int(home[j])) in reach


# ---- whitening ----------------------------------------------------------------------------------------------

@pytest.mark.parametrize("n,spread", [(1, 0), (2, 1), (7, 3), (40, 9), (40, 0), (64, 1)])
def test_spectrum(n, spread):
    r = np.random.default_rng(n)
    q = np.linalg.qr(r.standard_normal((n, n)))[0]
    want = 10.0 ** -np.linspace(0, spread, n) if spread else np.repeat([2.0, 1.0], [n - n // 2, n // 2])
    a = (q * want) @ q.T
    values, vectors = whitening.spectrum((a + a.T) / 2)
    assert np.abs(values - np.sort(want)[::-1]).max() < 1e-13
    assert np.abs(vectors.T @ vectors - np.eye(n)).max() < 1e-13 and np.abs(a @ vectors - vectors * values).max() < 1e-13


def test_polar_factor():
    a = np.random.default_rng(1).standard_normal((30, 30))
    a = a + a.T
    values, q = np.linalg.eigh(a)
    assert np.abs(whitening.polar(a) - (q * np.sign(values)) @ q.T).max() < 1e-12


def vectors(n, d, seed=0):
    r = np.random.default_rng(seed)
    return (r.standard_normal((n, d)) * np.linspace(3, 0.2, d) + 5 + 100 * (np.arange(d) == 2)).astype(np.float32)


def test_whitening(spark):
    good = vectors(300, 12)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(good)]
    rows += [(None, good[0].tolist(), 1), (7, good[7].tolist(), 1)]                        # no key, a row twice
    odd = [(900, None, 1), (901, [], 1), (902, [1.0, None], 1), (903, [math.nan] * 12, 1), (904, [math.inf] * 12, 1), (905, [1.0] * 5, 1)]
    d = table(spark, rows + odd, "vec_id long, embedding array<float>, label int")
    out = whitening.whiten(d, components=12).collect()
    x = np.floor(64.0 * np.array([r[1] for r in rows], np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    z = x - s / n
    values, q = np.linalg.eigh(z.T @ z / n)
    values, q = values[::-1], q[:, ::-1]
    assert len(out) == 12 * n and {r.n for r in out} == {n} and max(r.identity_error for r in out) < 1e-9
    want = {}
    for (key, *_), row, whole in zip(rows, z, x):
        want.setdefault(key, []).append((int(((n * whole - s) ** 2).sum()), np.abs(row @ q / np.sqrt(values))))
    got = {}
    for r in out:
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
        got.setdefault(r.vec_id, {}).setdefault(r.component, []).append((r.deviation, r.whitened))
    assert got.keys() == want.keys()
    for key, found in got.items():
        for c, pairs in found.items():
            assert len(pairs) == len(want[key])
            for deviation, w in pairs:
                assert any(deviation == dev and abs(abs(w) - white[c - 1]) < 1e-8 for dev, white in want[key])
    flips = {}                                               # a component has one sign for all rows
    for r in out:
        if r.vec_id is not None and abs(r.whitened) > 1e-6:
            flips.setdefault(r.component, set()).add(np.sign(r.whitened) * np.sign((z @ q)[r.vec_id, r.component - 1]))
    assert all(len(x) == 1 for x in flips.values())


def test_whitening_of_few_and_equal_rows(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [math.nan])], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect() == []       # no variance
    got = whitening.whiten(spark.createDataFrame([(1, [0.0, 1.0, 4.0]), (2, [1.0, 1.0, 4.0]), (3, [0.5, 1.0, 4.0])], schema)).collect()
    assert sorted((r.vec_id, r.component) for r in got) == [(1, 1), (2, 1), (3, 1)] and got[0].explained == pytest.approx(1.0)
    assert sorted(abs(round(r.whitened, 6)) for r in got) == pytest.approx([0.0, 1.224745, 1.224745])


# ---- byte-level BPE ---------------------------------------------------------------------------------------

ODD = ["'", " ", "  ", "\n", "\t", "s", "t", "re", "ve", "m", "ll", "d", "l", "v", "r", "e", "A", "é", "ß", "1", "٣", "²", "!", "…", "\u00a0", "\u2003", "\u0085",
       "\x1c", "汉", "字", "😀", "\u0301", "न", "ि", "x" * 30, "\U000323b0", "\U00011de3", "\u0558", "'s", "'S", " '", "\r\n", "_", "%", "<|endoftext|>"]


def odd_texts(n, seed=0, most=60):
    r = random.Random(seed)
    return ["".join(r.choice(ODD) for _ in range(r.randrange(most))) for _ in range(n)]


@pytest.fixture(scope="module")
def reference():
    import public_tokenizers
    import tiktoken
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("chunk", [1 << 20, 40, 7])
def test_ids_of_odd_texts(reference, monkeypatch, chunk):
    """The library's ids, also where a text goes through in many chunks."""
    monkeypatch.setattr(bpe, "CHUNK", chunk)
    own = bpe.Encoder(bpe._default(None))
    texts = ["", " ", "'s", "".join(odd_texts(40, 9)), *odd_texts(1500)]
    size, flat = own([t.encode() for t in texts])
    start = np.cumsum(size) - size
    for t, a, n in zip(texts, start.tolist(), size.tolist()):
        assert flat[a:a + n].tolist() == reference.encode_ordinary(t), t
    assert own.decode(flat.astype(np.int64)).tobytes().decode() == "".join(texts)


def test_merge_replay_equals_word_by_word():
    """Random merge tables, also ones whose order no training would give, on words with long runs of one symbol."""
    for seed in range(30):
        r = random.Random(seed)
        pairs, n = {}, 4
        for _ in range(25):
            a, b = r.randrange(n), r.randrange(n)
            pairs.setdefault(a << merges.SHIFT | b, n)
            n += 1
        if seed % 2:                                         # ids that do not follow the order of learning
            new = list(range(4, n))
            r.shuffle(new)
            name = dict(zip(range(4, n), new))
            at = lambda x: name.get(x, x)
            pairs = {at(k >> merges.SHIFT) << merges.SHIFT | at(k & merges.MARK): at(v) for k, v in pairs.items()}
        m = merges.Merges(pairs)
        words = [[r.randrange(r.choice([1, 2, 4])) for _ in range(r.randrange(1, 25))] for _ in range(200)]
        flat, size = m.replay(np.array([x for w in words for x in w]), np.array([len(w) for w in words]))
        start = np.cumsum(size) - size
        assert [flat[a:a + k].tolist() for a, k in zip(start, size)] == [m.one_by_one(w) for w in words]


def test_encode_and_decode(spark, reference):
    texts = [None, "", "one", "one", *odd_texts(60, 4), "long " * 30_000 + "x" * 50_000]
    rows = [(i if i % 7 else None, t, None, None, None) for i, t in enumerate(texts)] + [(3, "one", None, None, None)]
    d = table(spark, rows)
    for most in (1 << 18, 5, 0):                             # a dictionary of all pieces, of few, of none
        got = bpe.encode(d, most=most).collect()
        want = sorted((r[0] if r[0] is not None else -1, reference.encode_ordinary(r[1] or "")) for r in rows)
        assert sorted((r.doc_id if r.doc_id is not None else -1, r.ids) for r in got) == want and all(r.n_tokens == len(r.ids) for r in got)
    back = bpe.decode(bpe.encode(d).select("doc_id", "ids")).collect()
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    assert sorted(((r.doc_id, bytes(r.body)) for r in back), key=key) == sorted(((r[0], (r[1] or "").encode()) for r in rows), key=key)
    assert [bytes(r.body) for r in bpe.decode(spark.createDataFrame([(1, None), (2, [])], "k int, ids array<int>")).collect()] == [b"", b""]
    with pytest.raises(Exception, match="no token"):
        bpe.decode(spark.createDataFrame([(1, [10 ** 6])], "k int, ids array<int>")).collect()
    assert bpe.encode(spark.createDataFrame([], SCHEMA)).collect() == []


def test_round_trip_query(spark, reference, tmp_path):
    texts = [None, "", *odd_texts(80, 6)]
    spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(r) for r in queries.QUERIES["op13_bpe_round_trip"](spark, str(tmp_path)).collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert got == {(i, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode()))
                   for i, t in enumerate(texts) for ids in [reference.encode_ordinary(t or "")]}


def test_most_frequent_pieces(spark):
    rows = [(i, t, None, None, None) for i, t in enumerate(["b a a", "a a", None, "b" * 200])]
    got = {bytes(r.piece): r.n for r in bpe.count_pieces(table(spark, rows)).collect()}
    assert got == {b"b": 1, b" a": 3, b"a": 1}               # 200 letters are over the length of a dictionary piece


# ---- shared ---------------------------------------------------------------------------------------------

def test_remembered_rows_survive_forgetting():
    asked = []

    def compute(keys):
        def run(at):
            asked.extend(keys[at].tolist())
            return (keys[at] % 4).astype(np.int64), np.concatenate([np.full(k % 4, k) for k in keys[at].tolist()]).astype(np.int32)
        return run
    m = ragged.Remembered(5, np.int32)
    r = random.Random(0)
    for _ in range(200):
        keys = np.unique(np.array([r.randrange(40) for _ in range(r.randrange(1, 8))], np.uint64))
        size, flat = m.rows(keys, compute(keys))
        assert flat.tolist() == [k for k in keys.tolist() for _ in range(k % 4)] and size.tolist() == [k % 4 for k in keys.tolist()]
        assert len(m.young[0]) <= 5 + 8 and len(m.old[0]) <= 5 + 8
    assert len(asked) > 40


def test_word_tokenizer_equals_the_library():
    import public_tokenizers
    own = packing.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    r = random.Random(1)
    marks = [" ", "\n", "'s", "É", "ÿ", "×", "÷", "µ", "ª", "é", "İ", "Σ", "ſ", "ﬁ", "1", "２", "!", ".", ",", "\"", "<", "<|endoftext|>", "汉", "😀", "Th", "the", "ing", "|", "K", "Å", "-"]
    texts = ["", *["".join(r.choice(marks) for _ in range(r.randrange(40))) for _ in range(3000)]]
    want = [np.array(e.ids, "<u2").tobytes() for e in own.model.encode_batch_fast(texts, add_special_tokens=False)]
    assert own([t.encode() for t in texts]) == want and own.merges is not None
    own.merges, own.young = None, {b"": b""}                 # a file without merges in rank order: the library alone
    own.words = ragged.Remembered(10, np.uint16)
    assert own([t.encode() for t in texts]) == want
