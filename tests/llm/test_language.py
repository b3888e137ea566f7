import numpy as np

from pitlane.llm import language, registry

TEXTS = {"en": "the quick brown fox jumps over the lazy dog while this other one was sleeping with them",
         "de": "der schnelle braune fuchs springt über den faulen hund während dieser andere bei ihnen schlief",
         "fr": "le rapide renard brun saute par dessus le chien paresseux pendant que cet autre dormait avec eux"}


def model():
    codes = [language.grams([TEXTS[lang].encode()] * 20)[0] for lang in sorted(TEXTS)]
    code = np.concatenate(codes)
    return language.model_of(sorted(TEXTS), np.repeat(np.arange(3), [len(c) for c in codes]), code, np.ones(len(code), int))


def test_mixture_finds_the_set():
    m = model()
    names, score, share = m.infer([TEXTS["en"], TEXTS["de"], TEXTS["en"] + " " + TEXTS["fr"] * 2, None, "", "123 !?", "日本語"])
    assert names[:3] == ["en", "de", "fr"] and names[3:6] == ["und"] * 3
    assert score[0] == score[1] == 1 and score[3:6].sum() == 0
    assert (share[2] > 0).tolist() == [False, True, True]  # de, en, fr
    assert names[6] in m.languages


def test_grams_stay_inside_texts():
    for a, b in ((b"abcd ef", b"xyz"), (b"abcd x", b"yz")):
        both, word, doc = language.grams([a, b])
        alone = [language.grams([t])[0].tolist() for t in (a, b)]
        assert both.tolist() == alone[0] + alone[1]
        assert doc.tolist() == [0, 0, 1]


def test_batch_equals_single():
    m = model()
    texts = [TEXTS["en"], None, TEXTS["de"] + TEXTS["fr"], "x", TEXTS["fr"]]
    assert np.allclose(m.infer(texts)[2], np.vstack([m.infer([t])[2] for t in texts]), atol=1e-4)


def test_odd_rows(odd_docs, no_docs):
    m = language.fit(odd_docs)
    out = language.identified(odd_docs, m).collect()
    assert len(out) == odd_docs.count()
    assert all(r.lang_pred == "und" for r in out if not r.text or not any(map(str.isalpha, r.text)))
    assert all(0 <= r.lang_score <= 1 for r in out)
    nothing = language.fit(no_docs)
    assert nothing.languages == [] and language.identified(no_docs, nothing).count() == 0
    assert {r.lang_pred for r in language.identified(odd_docs, nothing).collect()} == {"und"}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = registry.op10_language(spark, sf).toPandas()
    x = out[out.held_out].merge(spark.read.parquet(f"{sf}/documents.parquet").toPandas(), on="doc_id")
    assert (x.lang_pred == x.lang).mean() > 0.98


def plain_grams(text):
    """The n-grams of each word, listed one by one: those of four bytes inside, a shorter word's whole."""
    words, run = [], b""
    for b in text.lower().encode() + b" ":
        if chr(b).isalpha() and b < 128 or b >= 128:
            run += bytes([b])
        elif run:
            words.append(run)
            run = b""
    return [[(b" " + w + b"   ")[i:i + 4] for i in range(max(1, len(w) - 1))] for w in words]


def test_counts_are_exact(spark):
    texts = [("en", "Hello a bc hello, worlds"), ("de", "straße über a"), ("en", "hello"), ("fr", "日本語 é")]
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(texts * 3)], "doc_id long, text string, lang string")
    from pitlane.llm.common import held_out
    used = docs.where(~held_out("doc_id", 4, 2)).collect()
    want = {}
    for r in used:
        for w in plain_grams(r.text):
            for g in w:
                key = (r.lang, int.from_bytes(g.ljust(4), "big"))
                want[key] = want.get(key, 0) + 1
    for most in (3, 500_000):
        m = language.fit(docs, most=most)
        total = {k: sum(n for (lang, _), n in want.items() if lang == k) for k in m.languages}
        size = len({c for _, c in want})
        assert m.codes.tolist() == sorted({c for _, c in want})
        for (lang, c), n in want.items():
            k = m.languages.index(lang)
            row = m.rows(np.array([c], np.uint32))[0]
            assert np.isclose(m.table[row, k], np.log((n + 0.5) / (total[lang] + 0.5 * (size + 1))), atol=1e-5)


def test_rows_are_found_exactly():
    rng = np.random.default_rng(1)
    codes = np.unique(rng.integers(0, 1 << 32, 5000, dtype=np.uint64).astype(np.uint32))
    m = language.Model(["x"], codes, np.zeros((len(codes) + 1, 1), np.float32))
    assert len(m.rest) > 0  # some cells are wanted by two
    asked = np.concatenate([codes, rng.integers(0, 1 << 32, 5000, dtype=np.uint64).astype(np.uint32)])
    at = {int(c): i for i, c in enumerate(codes)}
    assert m.rows(asked).tolist() == [at.get(int(c), len(codes)) for c in asked]


def plain_mixture(like, rounds, penalty):
    """Expectation-maximisation over one document's words, and the languages dropped one by one."""
    k = like.shape[1]

    def fit(pi, times):
        p = np.exp(like - like.max(axis=1, keepdims=True))
        for _ in range(times):
            r = p * pi
            pi = (r / r.sum(axis=1, keepdims=True)).mean(axis=0)
        return pi, np.log((p * pi).sum(axis=1)).sum()

    pi, ll = fit(np.full(k, 1 / k), rounds)
    while (pi > 0).sum() > 1:
        less = pi.copy()
        less[np.where(less > 0, less, 2).argmin()] = 0
        new, new_ll = fit(less / less.sum(), max(2, rounds // 4))
        if new_ll + penalty * np.log(len(like) + 1.0) < ll:
            break
        pi, ll = new, new_ll
    return pi


def test_mixture_against_plain_em():
    m = model()
    texts = [TEXTS["en"], TEXTS["de"] + " " + TEXTS["fr"], " ".join(TEXTS.values()), "der the", TEXTS["fr"] * 3 + " hund"]
    share = m.infer(texts)[2]
    at = {int(c): i for i, c in enumerate(m.codes)}
    for text, got in zip(texts, share):
        like = np.array([sum(m.table[at.get(int.from_bytes(g.ljust(4), "big"), len(m.codes))].astype(float) for g in w)
                         for w in plain_grams(text)])
        assert np.allclose(got, plain_mixture(like, 12, 2.0), atol=1e-3)
