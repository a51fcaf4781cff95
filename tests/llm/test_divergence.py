"""Source divergence against plain Python on odd rows, with tiles and blocks small enough to matter."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.ml.feature import CountVectorizerModel

from sessionloom.llm import divergence
from sessionloom.llm.shared import cut

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = {i: i + 32 for i in range(65, 91)}


def brute(rows, least=30, most=50):
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(UPPER))) for text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        seen = Counter(t for d in docs if d[0] == lang for t in set(d[2]))
        kept = {t for t, n in seen.items() if n >= least}
        counts = defaultdict(Counter)
        for _, source, terms in (d for d in docs if d[0] == lang):
            counts[source].update(t for t in terms if t in kept)
        whole = sum(counts.values(), Counter())

        def share(c, t, kept=kept):
            return 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept))

        for s, c in counts.items():
            pairs = [(sum(abs(share(c, t) - share(o, t)) for t in kept), x) for x, o in counts.items() if x != s]
            terms = [(share(c, t) - share(whole, t), t) for t in c if c[t] and share(c, t) > share(whole, t)]
            for part, found in (("pair", pairs), ("term", terms)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, k) for k, (value, item) in enumerate(ranked, 1) if part == "pair" or k <= most}
    return out


def rows(n=400, sources=9):
    rng = random.Random(5)
    out = []
    for k in range(n):
        lang, source = rng.choice(["en", "de", None, "", "x\x1fy"]), f"s{rng.randrange(sources)}"
        words = [f"w{chr(97 + int(rng.expovariate(0.3)) % 26)}{'É' if rng.random() < 0.1 else ''}" for _ in range(rng.randrange(40))]
        out.append((" ".join(words) + rng.choice(["", " WORDS1words", "\n\t."]), lang, source if rng.random() > 0.05 else rng.choice([None, ""])))
    out += [(None, "en", "quiet"), ("", "en", "mute"), ("only one", "zz", "lonely"), (None, None, None), ("ab " * 20_000, "en", "s1"), ("ab cd", "en", "s1"), ("ab cd", "en", "s1")]
    return out


@pytest.mark.parametrize(("tile", "block", "least"), [(64, 4096, 30), (2, 3, 10), (64, 4096, 100_000)])
def test_divergence(spark, tile, block, least):
    own = rows()
    docs = spark.createDataFrame([(t, a, s, 1, "p", 2, 3) for t, a, s in own], "text string, lang string, source string, index int, part string, nth int, p int")
    got = [tuple(r) for r in divergence.audit(docs, least, tile=tile, block=block).collect()]
    want = brute(own, least)
    assert len(got) == len(want) and set(got) == want


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert divergence.audit(docs).collect() == []


def test_bags(spark):
    """A text's terms come once each, in the bag of how often they occur there, however often that is; bytes beyond ASCII are never split or lowered."""
    docs = spark.createDataFrame([("B a,A É é  b1B_ b" + " zz" * 5000, "en", "s"), (None, "x\x1fy", None), ("\x1fİǅ \u0085ß'Ω", None, "")], "text string, lang string, source string")
    got = sorted((r["lang"], r["source"], r["times"], sorted(r["words"])) for r in divergence._bags(docs).collect())
    mark = "656e" + divergence.MARK
    assert got == [
        ("", "", 1, sorted(divergence.MARK + w for w in ("İǅ \u0085ß", "Ω"))), ("en", "s", 1, [mark + "É", mark + "é"]), ("en", "s", 2, [mark + "a"]), ("en", "s", 4, [mark + "b"]), ("en", "s", 5000, [mark + "zz"]), ("x\x1fy", "", 1, []),
    ]


def test_runs(spark):
    """However many texts of a source a task reads, a term is in one of its bags; what is seen of a language counts texts, up to the bound."""
    own = [(text, "de" if lang is None else lang, source) for text, lang, source in rows()]
    docs = spark.createDataFrame(own, "text string, lang string, source string").coalesce(1)
    counts, texts = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in own:
        terms = [f"{lang.encode().hex()}{divergence.MARK}{t}" for t in TERM.findall((text or "").translate(UPPER))]
        counts[lang, source or ""].update(terms)
        texts[lang].update(set(terms))
    bags = divergence._bags(docs).collect()
    got = sorted((r["lang"], r["source"], w, r["times"]) for r in bags for w in r["words"])
    assert got == sorted((*g, w, n) for g, c in counts.items() for w, n in c.items())
    assert {(r["lang"], r["source"]) for r in bags} == set(counts)
    seen = sorted((r["lang"], w, x["docs"]) for r in bags for x in r["seen"] for w in x["words"])
    assert seen == sorted((lang, w, min(n, 30)) for lang, c in texts.items() for w, n in c.items())


@pytest.mark.parametrize("loose", [-1, 40, 1 << 23])
def test_tally_in_slices(monkeypatch, loose):
    """Sums of sums are those of all slices, whenever they are taken."""
    monkeypatch.setattr(divergence, "LOOSE", loose)
    tally, want, texts = divergence._Tally(3), Counter(), Counter()
    for lang, source, text in [("en", "s", "b a b"), ("de", "s", ""), ("en", "t", " A1a "), ("en", "s", "a É"), ("de", "u", "   "), ("en", "s", "a"), ("de", "s", "É é"), ("en", "s", "c a")]:
        body = text.encode()
        tally.add([lang], [source], np.frombuffer(body, np.uint8), np.array([0, len(body)]))
        terms = TERM.findall(text.translate(UPPER))
        want.update((lang, source, lang.encode().hex() + divergence.MARK + t) for t in terms)
        texts.update((lang, lang.encode().hex() + divergence.MARK + t) for t in set(terms))
    bags = [r for batch in tally.bags() for r in batch.to_pylist()]
    assert {(r["lang"], r["source"], w): r["times"] for r in bags for w in r["words"]} == want
    assert {(r["lang"], r["source"]) for r in bags if not r["words"]} == {("de", "u")}
    assert {(r["lang"], w): x["docs"] for r in bags for x in r["seen"] for w in x["words"]} == {k: min(n, 3) for k, n in texts.items()}
    assert list(divergence._Tally(3).bags()) == []


def test_bags_are_transformed_once(spark):
    bags = cut(spark.createDataFrame([("en", "s", 3, ["a", "b"]), ("en", "s", 1, []), ("en", "t", 2, ["x"])], "lang string, source string, times long, words array<string>"), "bags")
    found = divergence._indices(CountVectorizerModel.from_vocabulary(["b", "a"], inputCol="words", outputCol="vector"), bags)
    assert sorted(tuple(r) for r in found.collect()) == [("en", "s", 3, 0), ("en", "s", 3, 1)]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("UDF(words") == 1
