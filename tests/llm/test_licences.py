from pitlane.llm import licences


def scan(spark, texts):
    df = spark.createDataFrame([(i, t, "d", "l") for i, t in enumerate(texts)],
                               "doc_id long, text string, digest string, licence string")
    out = licences.scanned(df, licences.known_licences(spark)).collect()
    return {r.doc_id: r for r in out}


def test_equal_texts_in_other_dress(spark):
    mit = licences.KNOWN[0][1]
    dressed = "Copyright (c) 2020 Somebody\n\n" + mit.upper().replace(",", " ,").replace("SUBLICENSE", "sub-licence")
    changed = mit.replace("without restriction", "with restriction")
    got = scan(spark, [mit, dressed, changed, "text before\nReleased under the MIT Licence!\nafter", None, "",
                       "Copyright 2020 X", " \n ", "* Licensed  under CC BY-NC 4.0 *", "Copyright\u00e9"])
    assert [got[i].licence for i in range(10)] == ["MIT", "MIT", None, None, None, None, None, None, "CC-BY-NC-4.0", None]
    assert got[3].notices == ["MIT"] and got[8].notices == ["CC-BY-NC-4.0"] and got[4].notices == []
    assert got[0].text_digest == got[1].text_digest != got[2].text_digest
    assert got[4].text_digest is None and got[6].text_digest is None


def test_odd_rows(odd_docs, no_docs, spark):
    known = licences.known_licences(spark)
    assert licences.scanned(odd_docs, known).count() == odd_docs.count()
    assert licences.scanned(no_docs, known).count() == 0


def test_repeats_stay_single(spark):
    df = spark.createDataFrame([(1, "Licensed under CC BY-NC 4.0.")] * 3 + [(1, None), (None, "Licensed under CC BY 4.0.")],
                               "doc_id long, text string")
    out = licences.scanned(df, licences.known_licences(spark)).collect()
    assert sorted(str(r.licence) for r in out) == ["CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-NC-4.0", "CC-BY-NC-4.0", "None"]


def dressed(text, n):
    """The same licence as another project would print it: other case, line ends, comment signs, list marks, spellings."""
    import re
    import textwrap
    body = [textwrap.fill(" ".join(p.split()), width=50 + 7 * n) for p in re.sub(r"\n(?=[0-9][.])", "\n\n", text).split("\n\n")]
    out = re.sub(r"\bLicense\b", "Licence", "\n\n".join(body)).replace(" organization", " organisation").replace("https:", "http:")
    if n % 3 == 0:
        out = "\n".join(" * " + line for line in out.split("\n"))
    if n % 3 == 1:
        out = out.upper().replace('"', "\u201d")
    return f"Copyright (c) 20{10 + n} Some Body\nAll rights reserved.\n\n{out}\n"


def test_every_known_licence_is_found_whole_in_other_dress(spark):
    texts = [dressed(t, n % 12) for n, (_, t) in enumerate(licences.KNOWN)]
    got = scan(spark, texts + [t.replace("without", "with") for _, t in licences.KNOWN])
    names = [n for n, _ in licences.KNOWN]
    assert [got[i].licence for i in range(len(names))] == names
    long = [i for i, (_, t) in enumerate(licences.KNOWN) if "without" in t]
    assert len(long) > 15 and all(got[len(names) + i].licence is None for i in long)


def test_lines_about_copyright_notices_are_text(spark):
    mit = licences.KNOWN[1][1].replace("\n", " ")
    cut = mit.replace(" copyright notice and", "\ncopyright notice and").replace("OR COPYRIGHT HOLDERS", "OR\nCOPYRIGHT HOLDERS")
    got = scan(spark, [cut, "Copyright 2020 A\n" + cut, "(c) by A\n" + cut, cut.replace("copyright notice and", "copyright 2020 and")])
    assert [got[i].licence for i in range(4)] == ["MIT", "MIT", "MIT", None]


def test_whole_licences_in_a_table(spark):
    """The registered catalogue over the given documents with licence files among them: rows equal DuckDB's."""
    import duckdb

    from pitlane.llm import registry
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").toPandas()
    more = [(10 ** 6 + n, dressed(t, n % 12)) for n, (_, t) in enumerate(licences.KNOWN)]
    both = list(docs.itertuples(index=False, name=None)) + more
    out = licences.scanned(spark.createDataFrame(both, "doc_id long, text string"), licences.known_licences(spark)).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", both)
    want = con.execute(registry.ORACLE["op7_licences"]).fetchall()
    assert sorted((r.doc_id, r.text_digest, r.licence, ",".join(r.notices)) for r in out if r.licence) == \
        sorted(w for w in want if w[2] is not None)
    assert sum(r.licence is not None for r in out) >= len(more)
    assert len(out) == len(want)


def test_a_large_catalogue_is_joined(spark, monkeypatch):
    texts = [licences.KNOWN[1][1], "a\nLicensed under CC BY 4.0.", "nothing"]
    want = [(r.licence, r.notices) for _, r in sorted(scan(spark, texts).items())]
    monkeypatch.setattr(licences, "CATALOGUE", 3)
    assert [(r.licence, r.notices) for _, r in sorted(scan(spark, texts).items())] == want
    assert want[0][0] == "MIT" and want[1][1] == ["CC-BY-4.0"]
