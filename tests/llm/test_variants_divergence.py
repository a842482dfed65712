"""Spelling variants and source divergence against plain Python."""

import re
import zlib
from collections import Counter, defaultdict

import compare
import numpy as np
import pytest

import __spark_entry__ as contract
from emberwatch.llm import divergence, variants

DOCS = "doc_id long, text string, lang string, source string, n string, term string"


@pytest.mark.parametrize("name", ["op12_variants", "op13_divergence"])
def test_query_matches_sql(name, spark, folder):
    with compare.database(folder) as database:
        assert compare.difference(contract.queries()[name](spark, folder), database, contract.oracle_sql()[name]) is None


def lower(text):
    return re.sub("[A-Z]", lambda match: match[0].lower(), text or "")


def brute_words(rows, noise):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[a-zÀ-ÿ]+", lower(text)):
            code = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if noise and code % noise == 0:
                run = run[: code % len(run)] + run[code % len(run) + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    return counts


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:at] + b[at + 1 :] == a for at in range(len(b)))


def brute_variants(counts):
    made = {}
    for word, n in counts.items():
        near = [other for other in counts if one_apart(word, other)]
        best = min(near, key=lambda other: (-counts[other], other), default=None)
        made[word] = (n, len(near), best if best and counts[best] >= 2 * n else None)
    rows = []
    for word, (n, near, form) in made.items():
        root = word
        while made[root][2]:
            root = made[root][2]
        rows.append((word, n, near, form, made[form][0] if form else None, root))
    return sorted(rows)


def variant_rows(spark, counts):
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    return sorted((row.word, row.n, row.n_near, row.form, row.form_n, row.root) for row in variants.group_variants(words).collect())


def test_variants_of_random_words(spark):
    """Few letters and repeated bigrams, words of four letters, and long ones that differ early or late."""
    rng = np.random.default_rng(8)
    words = {"".join(rng.choice(list("abé"), size=rng.integers(4, 9))) for _ in range(400)}
    base = "".join(rng.choice(list("abcdefgh"), size=2000))
    words |= {base, base[1:], base[:-1], "z" + base[1:], base[:1000] + "z" + base[1000:], base + "zz"}
    counts = {word: int(rng.integers(1, 60)) for word in sorted(words)}
    assert variant_rows(spark, counts) == brute_variants(counts)


def test_variants_broadcast_nothing(spark, monkeypatch):
    """Spark sizes keys and chains by the file of the words, far too low, and would send them to the driver."""
    plans, keep = [], variants.kept

    def kept(frame):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return keep(frame)

    monkeypatch.setattr(variants, "kept", kept)
    counts = {"straße": 40, "strasse": 9, "strase": 3, "strass": 1, "wörter": 7, "worter": 2}
    words = keep(spark.createDataFrame(list(counts.items()), "word string, n long"))
    found = variants.group_variants(words)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert len(plans) >= 4 and sum("Join" in plan for plan in plans) >= 3
    assert not any("Broadcast" in plan for plan in plans)
    assert sorted((row.word, row.n, row.n_near, row.form, row.form_n, row.root) for row in found.collect()) == brute_variants(counts)


def test_pivots_are_apart_and_cheapest():
    rng = np.random.default_rng(9)
    for _ in range(500):
        word = "".join(rng.choice(list("abcd"), size=rng.integers(4, 12)))
        grams = sorted({word[at : at + 2] for at in range(len(word) - 1)})
        costs = rng.integers(1, 9, len(grams)).tolist()
        order = sorted(range(len(grams)), key=lambda k: (costs[k], grams[k]))
        ranks = {grams[k]: (rank, costs[k]) for rank, k in enumerate(order)}
        prefix, last, (one, two) = variants.prefix_and_pivots(word, ranks)
        cost = [ranks[word[at : at + 2]][1] for at in range(len(word) - 1)]
        assert len(prefix) >= 3 and all(ranks[word[at : at + 2]][0] <= last for at in prefix)
        assert one in prefix and two in prefix and two - one >= 2
        assert cost[one] + cost[two] == min(cost[a] + cost[b] for a in prefix for b in prefix if b - a >= 2)


@pytest.mark.parametrize("noise", [97, 2, None])
def test_words_of_awkward_texts(spark, noise, monkeypatch):
    monkeypatch.setattr(variants, "LONG_TEXT", 5000)
    rows = [
        (1, "Straße straße STRASSE × ÷÷÷÷÷ Éclair éclair", "x", "y", None, None),
        (1, "Straße straße STRASSE × ÷÷÷÷÷ Éclair éclair", "x", "y", None, None),
        (None, "abcdef abcdef ghijk", None, None, None, None),
        (3, None, None, None, None, None),
        (4, "", None, None, None, None),
        (5, "wordy " * 2000 + "q" * 20000, None, None, None, None),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    got = {row.word: row.n for row in variants.count_words(docs, noise=noise).collect()}
    assert got == brute_words(rows, noise)
    assert variants.spelling_variants(docs.limit(0)).count() == 0
    assert variants.spelling_variants(docs, times=1, noise=noise).count() == len(got)


def test_short_words_are_refused(spark):
    with pytest.raises(ValueError):
        variants.spelling_variants(spark.createDataFrame([], DOCS), least=3)


def brute_audit(rows, least, top):
    counts, met, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lower(text))
        groups.add((lang, source))
        counts[lang, source].update(terms)
        met[lang].update(set(terms))
    rows = set()
    for lang in {lang for lang, _ in groups}:
        terms = [term for term, docs in met[lang].items() if docs >= least]
        own = {source: {term: counts[lang, source][term] for term in terms} for each, source in groups if each == lang}
        whole = {term: sum(count[term] for count in own.values()) for term in terms}
        share = lambda count: {term: 1 + 10**9 * (count[term] + 5) // (sum(count.values()) + 5 * len(terms)) for term in terms}
        q = share(whole)
        shares = {source: share(count) for source, count in own.items()}
        for source, p in shares.items():
            pairs = [(-sum(abs(p[t] - r[t]) for t in terms), other.encode()) for other, r in shares.items() if other != source]
            ahead = [(q[t] - p[t], t.encode()) for t in terms if own[source][t] and p[t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(ahead)[:top])):
                rows |= {(lang, source, part, item.decode(), -value, rank) for rank, (value, item) in enumerate(found, 1)}
    return rows


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(10)
    terms = ["a", "Ab", "é", "naïve", "eightlet", "ninelette", "ßßßßßßßß", "sixteenletters__x".replace("_", "y"), "seventeen" * 2, "seventeen" * 2 + "b", "長い言葉の列です", "z" * 9000]
    rows = []
    for number in range(160):
        lang, source = [("en", f"s{number % 7}"), ("de", "s1"), (None, None), ("en", None), ("xx", "lone")][rng.integers(5)]
        text = " ".join(rng.choice(terms, size=rng.integers(1, 12))) if number % 11 else [None, "", "12 !?"][number % 3]
        rows.append((number % 50, text, lang, source, "n", "t"))
    return rows + [(7, "12", "empty", "a", None, None), (8, None, "empty", "b", None, None)] + rows[:20]


@pytest.mark.parametrize("least, top, terms, tile", [(30, 50, 2048, 128), (3, 4, 3, 2), (1, 2, 1, 1)])
def test_audit(spark, corpus, monkeypatch, least, top, terms, tile):
    monkeypatch.setattr(divergence, "TERMS", terms)
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "SLICE", 2000)
    docs = spark.createDataFrame(corpus, DOCS)
    got = divergence.audit(docs, least, top).collect()
    assert {tuple(row) for row in got} == brute_audit(corpus, least, top) and len(got) == len(set(got))


def test_audit_of_nothing(spark):
    assert divergence.audit(spark.createDataFrame([], DOCS)).count() == 0


def test_shares_do_not_overflow(spark):
    for count, total, terms in [(10**15, 8 * 10**15, 10**6), (0, 0, 1), (7, 7, 1), (0, 10**13, 5), (0, 0, 0)]:
        row = spark.range(1).selectExpr(f"{count}L AS n", f"{total}L AS total", f"{terms}L AS terms").select(divergence._share("n", "total", "terms").alias("p")).first()
        whole = total + 5 * terms
        assert row.p == (1 + 10**9 * (count + 5) // whole if whole else 1)


def test_radix_order():
    rng = np.random.default_rng(11)
    words = [rng.integers(0, 3, 500).astype(np.uint64) << np.uint64(60), rng.integers(0, 2**63, 500).astype(np.uint64)]
    assert divergence.radix_order(words).tolist() == np.lexsort(words[::-1]).tolist()
