"""URL filter: host and path rules first, then a character language-model ratio.

Variable-order Markov models of accepted and of rejected URLs are counted over all
URLs that a rule decides. A URL without a rule is judged by the difference of its
length-normalised log-likelihoods, against a threshold calibrated on ruled URLs that
were kept out of the counts. The counts stay a table in the shared folder, however
many n-grams there are; texts to score are joined with it in small groups.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import prepare, quoted, stored, tasks

#: (verdict, rule): host, then the path's start.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/")]
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_START, _END = "\x02", "\x03"
ALPHABET = 128


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host and path of the URL in a column; both empty for null and where ``://`` is missing."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _UPPER.lower())
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls; equal ones: the first given."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, start = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + start))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def grams(text: str, order: int) -> list[str]:
    """Each character with up to ``order`` before it, longest and all shorter ones."""
    s = _START * order + text + _END
    return [s[j:i + 1] for i in range(order, len(s)) for j in range(i - order, i + 1)]


@dataclass
class Markov:
    """Interpolated Witten-Bell estimates; a context without counts falls back to a shorter one."""

    counts: dict[str, int]
    order: int
    followers: dict[str, tuple[int, int]] | None = None

    def __post_init__(self):
        if self.followers is not None:
            return
        total: Counter = Counter()
        kinds: Counter = Counter()
        for g, n in self.counts.items():
            total[g[:-1]] += n
            kinds[g[:-1]] += 1
        self.followers = {c: (total[c], kinds[c]) for c in total}

    def log_likelihood(self, text: str) -> float:
        s = _START * self.order + text + _END
        out = 0.0
        for i in range(self.order, len(s)):
            p = 1 / ALPHABET
            for j in range(i, i - self.order - 1, -1):
                seen = self.followers.get(s[j:i])
                if seen is None:
                    break
                n, kinds = seen
                p = (self.counts.get(s[j:i + 1], 0) + kinds * p) / (n + kinds)
            out += math.log(p)
        return out / (len(text) + 1)


@dataclass
class Model:
    """``table`` has one row per n-gram ``g``: how often it was seen in URLs to allow and to
    block, and how often and by how many characters it was followed as a context."""

    table: DataFrame
    order: int
    threshold: float = 0.0

    def scores(self, texts: DataFrame, size: int = 100_000) -> DataFrame:
        """(text, score) of the distinct values of ``text``.

        Texts are dealt by hash into groups of about ``size`` characters; each group's
        distinct n-grams are joined with the counts, so a frequent n-gram is looked up
        once per group and no task needs the whole table.
        """
        spark, order = texts.sparkSession, self.order
        texts = stored(texts.select("text").distinct(), "texts")
        length = texts.agg(F.sum(F.length("text").cast("long") + 1)).head()[0] or 0
        groups = max(tasks(spark), -(-length // size))
        texts = texts.withColumn("part", F.pmod(F.xxhash64("text"), F.lit(groups)))

        def needed(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            found = {_START * k for k in range(order + 1)}
            for t in table["text"].to_pylist():
                found.update(grams(t, order))
            return pa.table({"part": pa.array([key[0].as_py()] * len(found), pa.int64()),
                             "g": pa.array(list(found), pa.string())})

        def judge(key: tuple[pa.Scalar, ...], table: pa.Table, counts: pa.Table) -> pa.Table:
            names = counts["g"].to_pylist()
            kinds = []
            for v in ("allow", "block"):
                n, total, after = (counts[f"{v}_{c}"].to_pylist() for c in ("n", "total", "kinds"))
                kinds.append(Markov({g: k for g, k in zip(names, n) if k}, order,
                                    {g: (t, k) for g, t, k in zip(names, total, after) if t}))
            own = table["text"].to_pylist()
            score = [kinds[0].log_likelihood(t) - kinds[1].log_likelihood(t) for t in own]
            return pa.table({"text": pa.array(own, pa.string()), "score": pa.array(score, pa.float64())})

        wanted = texts.groupBy("part").applyInArrow(needed, "part long, g string")
        counts = wanted.join(self.table, "g")
        return (texts.groupBy("part").cogroup(counts.groupBy("part"))
                .applyInArrow(judge, "text string, score double"))

    def score(self, text: str) -> float:
        one = self.table.sparkSession.createDataFrame([(text,)], "text string")
        return self.scores(one).head()["score"]


def fit(judged: DataFrame, order: int = 5, least: int = 3) -> Model:
    """Model of the rows (text, verdict) with a verdict.

    Every n-gram of all rows but a fifth (by crc32) is counted in Spark, and every
    count is kept. Contexts seen less than ``least`` times are left out, which makes the
    order variable; the others keep all their followers. The threshold is where the
    kept-out fifth is parted best, both kinds counting the same.
    """
    prepare(judged.sparkSession)
    rows = judged.where(F.col("verdict").isNotNull()).select("text", "verdict")
    apart = F.crc32(F.col("text").cast("binary")) % 5 == 0

    def count(batches):
        total: dict[str, Counter] = {"allow": Counter(), "block": Counter()}
        for b in batches:
            for text, verdict in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                total[verdict].update(grams(text, order))
            for verdict, c in total.items():
                if len(c) > 200_000:  # partial counts leave the task before they grow
                    yield _rows(verdict, c)
                    c.clear()
        for verdict, c in total.items():
            yield _rows(verdict, c)

    def _rows(verdict: str, c: Counter) -> pa.RecordBatch:
        none, n = pa.array([0] * len(c), pa.int64()), pa.array(list(c.values()), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), pa.string()), *((n, none) if verdict == "allow" else (none, n))],
            ["gram", "allow", "block"])

    counted = (rows.where(~apart).mapInArrow(count, "gram string, allow long, block long")
               .groupBy("gram").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")))
    zero = F.lit(0).cast("long")
    as_gram, as_context = [F.col("gram").alias("g")], [F.expr("left(gram, length(gram) - 1)").alias("g")]
    sums = []
    for v in ("allow", "block"):
        as_gram += [F.col(v).alias(f"{v}_n"), zero.alias(f"{v}_total"), zero.alias(f"{v}_kinds")]
        as_context += [zero.alias(f"{v}_n"), F.col(v).alias(f"{v}_total"),
                       (F.col(v) > 0).cast("long").alias(f"{v}_kinds")]
        often = (F.sum(f"{v}_total") >= least) | (F.col("g") == "")
        sums += [F.sum(f"{v}_n").alias(f"{v}_n"),
                 *(F.when(often, F.sum(f"{v}_{c}")).otherwise(0).alias(f"{v}_{c}") for c in ("total", "kinds"))]
    table = (counted.select(F.explode(F.array(F.struct(*as_gram), F.struct(*as_context))).alias("r"))
             .select("r.*").groupBy("g").agg(*sums))
    model = Model(stored(table, "ngrams"), order)
    kept_out = (rows.where(apart).groupBy("text")
                .agg(*(F.count_if(F.col("verdict") == v).alias(v) for v in ("allow", "block"))))
    bins = (kept_out.join(model.scores(kept_out), "text")
            .groupBy(F.floor(F.col("score") * 200).alias("bin"))
            .agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")).orderBy("bin").collect())
    allow, block = sum(r["allow"] for r in bins), sum(r["block"] for r in bins)
    best, low = (-1.0, 0.0), 0
    good = allow
    for r in bins:  # accept from this bin on; the bins are few, however many rows there are
        right = (good / allow if allow else 0) + (low / block if block else 0)
        best = max(best, (right, r["bin"] / 200))
        good, low = good - r["allow"], low + r["block"]
    model.threshold = best[1] if allow and block else -math.inf
    return model


def judged(pages: DataFrame, rules: list[tuple[str, str]] | None = None, order: int = 5) -> DataFrame:
    """``pages`` with host, path, rule, url_score and verdict (allow or block).

    A rule fits a host and its subdomains if the path starts with the rule's path;
    the longest wins. Without one the model decides (null url_score never occurs; a
    null URL is scored as an empty text). The model counts and scores whole URLs, query and
    fragment too, scheme and host in lower case; one without ``://`` all in lower case. If no
    ruled URLs of both kinds exist, URLs without a rule are allowed. Rows are judged
    one by one: repeats stay; columns of these five names are replaced.
    """
    prepare(pages.sparkSession)
    new = ("host", "path", "rule", "url_score", "verdict")
    # The caller's columns travel in a struct, so no inner name meets one of theirs.
    row = F.struct(*[quoted(c).alias(c) for c in pages.columns if c.lower() not in new])
    host, path = host_and_path("url")
    base = pages.select(row.alias("row"), "url", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules or RULES)
    base = base.withColumns({"rule": rule, "ruled": verdict})
    before = F.translate(F.expr("left(url, instr(url, '://') + 2)"), _UPPER, _UPPER.lower())
    after = F.expr("substring(url, instr(url, '://') + 3 + length(host))")
    text = F.when(F.instr("url", "://") > 0, F.concat(before, "host", after)).otherwise(F.lower("url"))
    base = base.withColumn("text", F.coalesce(text, F.lit(""))).drop("url")
    model = fit(base.select("text", F.col("ruled").alias("verdict")), order)
    scores = model.scores(base.select("text"))
    scores = scores.select(F.col("text").alias("scored"), F.col("score").alias("url_score"))
    out = base.join(scores, F.col("text") == F.col("scored"))
    by_model = F.when(F.col("url_score") >= F.lit(model.threshold), "allow").otherwise("block")
    return out.withColumn("verdict", F.coalesce("ruled", by_model)).select("row.*", *new)
