"""The source audit against a plain dense version with Python integers."""

import random
import re
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from forgelake.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs):
    docs = [(lang or "", source or "", text) for _, text, lang, source in docs]
    rows = []
    for lang in sorted({d[0] for d in docs}):
        own = [d for d in docs if d[0] == lang]
        found = Counter(t for _, _, text in own for t in set(words(text)))
        kept = sorted(t for t, n in found.items() if n >= 3)
        counts = defaultdict(Counter)
        for _, source, text in own:
            counts[source].update(t for t in words(text) if t in set(kept))
        v = len(kept)

        def share(c, t):
            return 1 + 1_000_000_000 * (c[t] + 1) // (sum(c.values()) + v)

        whole = sum(counts.values(), Counter())
        q = {t: share(whole, t) for t in kept}
        p = {s: {t: share(counts[s], t) for t in kept} for s in counts}
        for s in counts:
            f = lambda a, b: (a - b) ** 2 // b
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in counts if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items, top in (("pair", pairs, None), ("term", terms, 200)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                rows += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(items[:top], 1)]
    return sorted(rows)


def found(spark, docs):
    schema = "doc_id long, text string, lang string, source string, term string, count long, number int, p long, v long"
    df = spark.createDataFrame([(*d, "x", 1, 1, 1, 1) for d in docs], schema).repartition(3)
    return sorted(map(tuple, divergence.audit(df).collect()))


def test_against_a_dense_version(spark):
    rng = random.Random(5)
    vocabulary = ["Alpha", "beta", "GAMMA", "été", "été", "日本", "x", "don't", "a-b", " ", "\u0085", "zz"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(30))), rng.choice(["en", "en", "fr", None]), rng.choice(["a", "a", "a", "b", "c", "é", None])) for i in range(250)]
    docs += [(1, None, "en", "only"), (1, None, "en", "only"), (2, "", "xx", "one"), (3, "... 123", "xx", "two"), (None, "alpha alpha beta", "en", "a"), (None, "rare", None, None)]
    docs += [(9, "lone " * 5, "yy", "s")] * 2 + [(9, "lone", "zz", "s")] * 3
    assert found(spark, docs) == plain(docs)


def test_more_terms_than_ranks(spark):
    docs = [(i, " ".join("q" + "".join(chr(97 + (n // 26**k) % 26) for k in range(2)) for n in range(300)), "en", s) for i, s in enumerate("aab")] + [(9, "zebra " * 700, "en", "b")] * 3
    got = found(spark, docs)
    assert got == plain(docs)
    assert max(r[5] for r in got if r[2] == "term") == 200


def test_no_documents(spark):
    assert found(spark, []) == []


def test_small_buffers_and_pieces(spark, monkeypatch):
    text = "Aa bb\tcc " * 50
    whole = divergence.terms(text.encode())
    monkeypatch.setattr(divergence, "PIECE", 7)
    assert divergence.terms(text.encode()) == whole == Counter({b"aa": 50, b"bb": 50, b"cc": 50})
    assert divergence.terms(b"z" * 100) == Counter({b"z" * 100: 1})


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_terms_are_those_of_the_pattern(text):
    assert divergence.terms(text.encode()) == Counter(w.encode() for w in words(text))
