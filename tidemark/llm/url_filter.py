"""URL verdicts: listed rules first, else a logistic regression (DataFrame functions and Spark's own estimators only).

The regression sees the hashed character n-grams of host and path and is fitted on a small labelled URL table, made by
rule from lists of words and of names that hold no word, which are allowed; it blocks from a probability of LEAST. There
are many more buckets than n-grams in the table, so an n-gram that it does not have hardly ever weighs anything. Its coefficients have a fixed number of buckets, so the model's size does not depend on the data. Pages are scored where
they lie: the plan has no shuffle.

Defined results: a url that is null or has no ``://`` has empty host and path, no n-gram and no rule, and is allowed;
repeated rows give repeated verdicts; other columns of pages are not read.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shared import ascii_lower

BUCKETS, REG = 1 << 15, 0.01
GRAMS = (3, 4, 5)
#: (verdict, host, path): fixed values of the query's contract.
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)
#: Words of addresses that a curator blocks and that one allows, from general knowledge; ends that both have.
BLOCKED = """
ads adserver banner popup tracker clickbait adult porn xxx sex nude escort webcam casino poker slots roulette jackpot betting lottery
pills viagra cialis pharmacy replica warez crack keygen torrent phishing malware spam spammer spambot linkfarm botnet payday giveaway cheap hacked
""".split()
ALLOWED = """
library museum university school college theatre orchestra gallery archive encyclopedia journal science physics chemistry biology geology
astronomy mathematics history geography language literature poetry grammar dictionary translation news weather radio gazette herald observer
council ministry parliament court police hospital clinic nursing dentist insurance bank railway airport harbour station ferry bicycle
garden meadow orchard forest river mountain island valley bridge castle village town kitchen recipes bakery coffee carpentry pottery
knitting chess football tennis swimming hiking sailing camping photography software database compiler network standards manual forum wiki
""".split()
ENDS = ("online", "world", "center", "house", "daily", "group", "point", "land")
PREFIXES = ("", "www.", "m.", "blog.")
PATHS = ("/en/{}", "/de/{}.html", "/fr/{}/", "/es/{}", "/page/{}", "/a/b/{}")
#: Least probability at which the regression blocks: about the share of blocked urls in the table.
LEAST = 0.2


#: Letters of names without words, and how many such names the table has.
CONSONANTS, VOWELS, PLAIN = "bcdfghjklmnprstvwz", "aeiou", 400


def plain_names(n: int) -> list[str]:
    """Names without words, from a fixed sequence of numbers: pronounceable ones and, every fourth, letters and digits by chance."""
    state, out = 1, []

    def draw(letters: str) -> str:
        nonlocal state
        state = (state * 1103515245 + 12345) % (1 << 31)
        return letters[(state >> 8) % len(letters)]

    for i in range(n):
        if i % 4 == 3:
            out.append("".join(draw(CONSONANTS + VOWELS + "0123456789") for _ in range(6 + i % 7)))
        else:
            out.append("".join(draw(CONSONANTS) + draw(VOWELS) + (draw("nrstl") if i % 3 == 0 else "") for _ in range(2 + i % 3)))
    return out


def labelled() -> list[tuple[str, float]]:
    """The small labelled URL table: each word alone, before an end and with the next word, and names without words, under names reserved for tests."""
    out = []
    for n, name in enumerate(plain_names(PLAIN)):
        out.append((f"https://{PREFIXES[n % len(PREFIXES)]}{name}.{('test', 'example', 'invalid')[n % 3]}{PATHS[n % len(PATHS)].format(n)}", 0.0))
    for label, words in ((1.0, BLOCKED), (0.0, ALLOWED)):
        for i, word in enumerate(words):
            hosts = (word, f"{word}-{ENDS[i % len(ENDS)]}", f"{ENDS[i // 2 % len(ENDS)]}-{word}", f"{word}-{words[(i + 1) % len(words)]}", word + ENDS[i // 3 % len(ENDS)])
            for j, host in enumerate(hosts):
                n = 7 * i + j
                out.append((f"https://{PREFIXES[n % len(PREFIXES)]}{host}.{('test', 'example', 'invalid')[n % 3]}{PATHS[n % len(PATHS)].format(n)}", label))
    return out


def split_url(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``, ``#`` or the end."""
    part = lambda group: F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", group), F.lit(""))
    return ascii_lower(part(1)), part(2)


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, or nulls."""
    rule = verdict = F.lit(None).cast("string")
    for say, own, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        rule, verdict = F.when(fits, own + start).otherwise(rule), F.when(fits, say).otherwise(verdict)
    return rule, verdict


def ngrams(host: Column, path: Column) -> Column:
    """Distinct character n-grams of host and path, each with the part's mark."""

    def of(mark: str, text: Column, n: int) -> Column:
        at = F.sequence(F.lit(1), F.greatest(F.length(text) - (n - 1), F.lit(1)))
        grams = F.transform(at, lambda i: F.concat(F.lit(mark), F.substring(text, i, F.lit(n))))
        return F.when(F.length(text) >= n, grams).otherwise(F.array().cast("array<string>"))

    parts = (("h", F.concat(F.lit("^"), host, F.lit("$"))), ("p", path))
    return F.array_distinct(F.flatten(F.array(*[of(mark, text, n) for mark, text in parts for n in GRAMS])))


def featured(urls: DataFrame) -> DataFrame:
    host, path = split_url(F.col("url"))
    parts = urls.withColumns({"host": host, "path": path})
    grams = F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(ngrams(F.col("host"), F.col("path")))
    return parts.withColumn("grams", grams)


def fit(spark: SparkSession, table: list[tuple[str, float]] | None = None) -> PipelineModel:
    """The regression on a small labelled table of urls (1 blocks), by default the one above."""
    urls = [F.struct(F.lit(url).alias("url"), F.lit(label).alias("label")) for url, label in table or labelled()]
    hashed = HashingTF(numFeatures=BUCKETS, binary=True, inputCol="grams", outputCol="features")
    rows = hashed.transform(featured(spark.range(0, 1, 1, 1).select(F.inline(F.array(*urls)))))
    model = LogisticRegression(regParam=REG, maxIter=200, tol=1e-9).fit(rows)
    return PipelineModel([hashed, model.setFeaturesCol("features")])


def judge(pages: DataFrame, model: PipelineModel | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict: the rule's, else the regression's."""
    model = model or fit(pages.sparkSession)
    scored = model.transform(featured(pages.select("page_id", "url")))
    rule, listed = rule_for(F.col("host"), F.col("path"))
    method = F.when((vector_to_array("probability")[1] >= LEAST) & (F.col("host") != ""), "block").otherwise("allow")
    return scored.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(listed, method).alias("verdict"))
