"""Matching products to models: precision first, with a reason for every refusal."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.urls import core_model, upper_alnum
from tidemark.streaming.run import work_dir

#: Words that may stand between a size and a series in a title.
SIZE_TOKENS = ("class", "inch", "in", '"', "series")
#: Words of a URL slug that say nothing about the model.
CONNECTORS = ("inch", "inches", "class", "series", "tv", "uhd", "4k", "hdr", "smart")
#: Most connector words and most other words in one window of a slug.
MOST_CONNECTORS, MOST_WORDS = 5, 4


@dataclass(frozen=True)
class MatchRules:
    """Settings of one shop; a core of three characters is safe only where pages report their own model."""

    reject_words: tuple[str, ...] = ()
    allow_core: bool = True
    min_core_len: int = 4
    size_tokens: tuple[str, ...] = SIZE_TOKENS

    def problems(self, pages_report_model: bool) -> list[str]:
        short = self.allow_core and self.min_core_len < 4 and not pages_report_model
        return ["min_core_len under 4 needs pages that report their own model"] * short


def quoted(text: Column) -> Column:
    """Text as a pattern that matches only itself."""
    return F.regexp_replace(text, r"([^A-Za-z0-9 ])", r"\\$1")


def matches(target: Column, title: Column, url: Column, own_models: Column, rules: MatchRules) -> Column:
    """Struct of rule (the one that decided) and ok.

    The first decisive rule wins: reject words; the page's own models, of which one must equal the target; the target
    as a word of title or url, sizes allowed before it; the core, if it is long enough and the sizes next to it agree.
    """
    low, model = F.lower(title), F.lower(target)
    core = core_model(target)
    size = F.nullif(F.regexp_extract(target, r"^(\d{2,3})", 1), F.lit(""))
    rejected = F.lit(False)
    for word in rules.reject_words:
        rejected = rejected | F.contains(low, F.lit(word.lower()))
    named = F.coalesce(F.size(F.filter(own_models, lambda m: m.isNotNull() & (m != ""))), F.lit(0)) > 0
    equal = F.coalesce(F.exists(own_models, lambda m: upper_alnum(m) == upper_alnum(target)), F.lit(False))
    word = F.concat(F.lit(r"(?:^|[^a-z0-9]|\d{2,3})"), quoted(model), F.lit(r"(?=[^a-z0-9]|$)"))
    exact = F.regexp_like(low, word) | F.coalesce(F.regexp_like(F.lower(url), word), F.lit(False))
    between = "(?:[ \\-]|" + "|".join(sorted((t.replace('"', '"') for t in rules.size_tokens), key=len, reverse=True)) + ")*"
    near = F.regexp_extract_all(low, F.concat(F.lit(r"(\d{2,3})" + between), quoted(F.lower(core))), F.lit(1))
    has_core = F.contains(upper_alnum(title), core) & (F.length(core) > 0)
    long_enough = F.length(core) >= rules.min_core_len
    size_ok = size.isNull() | (F.size(near) == 0) | F.array_contains(near, F.coalesce(size, F.lit("")))
    answer = lambda rule, ok: F.struct(F.lit(rule).alias("rule"), F.lit(ok).alias("ok"))
    return (
        F.when(rejected, answer("reject_word", False))
        .when(named & equal, answer("own_model", True))
        .when(named, answer("own_model_differs", False))
        .when(exact, answer("exact", True))
        .when(~has_core, answer("no_such_series", False))
        .when(F.lit(not rules.allow_core) | ~long_enough, answer("core_too_short", False))
        .when(~size_ok, answer("wrong_size", False))
        .otherwise(answer("core", True))
    )


def refusals(pairs: DataFrame, target: str, title: str, match: str, rules: MatchRules) -> DataFrame:
    """Per target that nothing matched: why, and the sizes in which its series was seen, ascending.

    pairs: targets with the titles they met and what ``matches`` said. A title without a size adds none. A size that was
    seen after all is not the reason: then reject words, the length of the core or word boundaries are.
    """
    core, size = core_model(F.col(target)), F.regexp_extract(target, r"^(\d{2,3})", 1).try_cast("int")
    series = F.contains(upper_alnum(F.col(title)), core) & (core != "")
    seen = F.regexp_extract(F.lower(title), r"(?:^|[^a-z0-9])(\d{2,3})(?=[^a-z0-9]|$)", 1).try_cast("int")
    marked = pairs.select(
        F.col(target).alias("target"), F.col(f"{match}.ok").alias("_ok"), F.coalesce(series, F.lit(False)).alias("_series"),
        F.when(series, seen).alias("_seen"), size.alias("_size"), F.length(core).alias("_core"),
    )
    found = marked.groupBy("target").agg(
        F.max("_ok").alias("_ok"), F.max("_series").alias("_series"), F.sort_array(F.collect_set("_seen")).alias("_sizes"), F.max("_size").alias("_size"), F.max("_core").alias("_core")
    )
    other = (F.size("_sizes") > 0) & F.col("_size").isNotNull() & ~F.array_contains("_sizes", F.coalesce("_size", F.lit(0)))
    short = F.lit(not rules.allow_core) | (F.col("_core") < rules.min_core_len)
    reason = F.when(~F.col("_series"), "no_such_series").when(short, "core_too_short").when(other, "other_sizes").otherwise("check_rules")
    sizes = F.array_join(F.transform("_sizes", lambda x: x.cast("string")), "/")
    return found.filter(~F.coalesce("_ok", F.lit(False))).select("target", reason.alias("reason"), sizes.alias("sizes"), F.col("_size").cast("long").alias("wanted"))


def slug_windows(slug: Column) -> Column:
    """Concatenations of up to MOST_WORDS neighbouring words, connectors left out, as normalised models.

    A window may hold at most MOST_CONNECTORS connectors, and none at its ends.
    """
    words = F.filter(F.split(F.lower(slug), "-"), lambda w: w != "")
    tagged = F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    kept = F.filter(tagged, lambda x: ~x["w"].isin(*CONNECTORS))
    n = F.size(kept)

    def of(width: int) -> Column:
        starts = F.when(n >= width, F.sequence(F.lit(1), n - width + 1)).otherwise(F.array().cast("array<int>"))
        spans = F.transform(starts, lambda s: F.slice(kept, s, F.lit(width)))
        close = F.filter(spans, lambda p: F.element_at(p, -1)["i"] - F.element_at(p, 1)["i"] - (width - 1) <= MOST_CONNECTORS)
        return F.transform(close, lambda p: F.upper(F.array_join(F.transform(p, lambda x: x["w"]), "")))

    return F.array_distinct(F.flatten(F.array(*[of(w) for w in range(1, MOST_WORDS + 1)])))


def match_slugs(models: DataFrame, catalog: DataFrame, model: str, slug: str) -> DataFrame:
    """Rows of catalog with the models that their slug names: windows are exploded and met by an equi-join."""
    wanted = models.withColumn("_m", upper_alnum(F.col(model))).filter("_m <> ''")
    return catalog.withColumn("_m", F.explode(slug_windows(F.col(slug)))).join(wanted, "_m").drop("_m")


def block_candidates(models: DataFrame, catalog: DataFrame, model: str, title: str) -> DataFrame:
    """Pairs of a model and a row of catalog whose title has the model's core: the cheap filter before ``matches``.

    Windows of up to three words of the title, with and without a leading size, meet the cores in an equi-join.
    """
    words = F.filter(F.split(F.upper(F.col(title)), "[^A-Z0-9]+"), lambda w: w != "")
    n = F.size(words)

    def of(width: int) -> Column:
        starts = F.when(n >= width, F.sequence(F.lit(1), n - width + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda s: F.array_join(F.slice(words, s, F.lit(width)), ""))

    every = F.flatten(F.array(*[of(w) for w in (1, 2, 3)]))
    keys = F.array_distinct(F.concat(F.transform(every, core_model), every))
    wanted = models.withColumn("_m", core_model(F.col(model))).filter("_m <> ''")
    return catalog.withColumn("_m", F.explode(keys)).join(wanted, "_m").drop("_m").distinct()


def title_keys(title: Column) -> Column:
    """What a model's first word can be in a title: each word, and what follows two digits within a word."""
    low = F.lower(F.coalesce(title, F.lit("")))
    return F.array_distinct(F.concat(F.regexp_extract_all(low, F.lit("([a-z0-9]+)"), F.lit(1)), F.regexp_extract_all(low, F.lit("(?<=[0-9]{2})(?=([a-z0-9]+))"), F.lit(1))))


def word_candidates(models: DataFrame, catalog: DataFrame, model: str, title: str, key: str, where: str) -> DataFrame:
    """Pairs (key, model) whose title holds the model's rarest word: every pair that ``word_matches`` can accept.

    Titles are taken apart once, into postings of the words that models have, a table in the folder ``where``; it says
    how frequent each word is, and each model is looked up by its rarest. A frequent word is met only by models that
    have none but frequent ones, and the equi-join on it can be split by Spark.
    """
    spark = catalog.sparkSession
    own = models.select(F.col(model).alias("model"), F.explode(F.array_distinct(F.regexp_extract_all(F.lower(model), F.lit("([a-z0-9]+)"), F.lit(1)))).alias("word")).distinct()
    keys = catalog.select(F.col(key).alias("key"), F.explode(title_keys(F.col(title))).alias("word"))
    keys.join(own.select("word").distinct(), "word", "left_semi").write.parquet(where)
    postings = spark.read.parquet(where)
    counts = postings.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    known = own.join(counts, "word", "left")
    rarest = known.groupBy("model").agg(F.min_by("word", F.struct(F.coalesce("n", F.lit(0)), "word")).alias("word"))
    return postings.join(rarest, "word").select("key", "model")


def word_matches(models: DataFrame, catalog: DataFrame, model: str, title: str, key: str, where: str) -> DataFrame:
    """Pairs (key, model) where the model stands in the title as words, sizes of two or three digits allowed before it.

    ``key`` must be unique in catalog. A model of one word needs no look at the title: its key is the rule. Null or empty models match nothing.
    """
    found = word_candidates(models.filter(F.col(model).rlike("[A-Za-z0-9]")), catalog, model, title, key, where)
    single = F.col("model").rlike("^[A-Za-z0-9]+$")
    pattern = F.concat(F.lit(r"(?:^|[^a-z0-9]|\d{2,3})"), quoted(F.lower("model")), F.lit(r"(?=[^a-z0-9]|$)"))
    rest = found.filter(~single).join(catalog.select(F.col(key).alias("key"), F.lower(title).alias("_t")), "key").filter(F.regexp_like("_t", pattern))
    return found.filter(single).unionByName(rest.select("key", "model"))


#: Widths of a passage's grams behind a word start, and the longest key of a passage that has none of them.
GRAMS, RUN = (12, 4), 8
STARTS = r"(?<![A-Za-z0-9])"


def passage_grams(passage: Column) -> Column:
    """Array of (kind, gram) by which a passage can be found: its grams at inner word starts, of the widest width that fits, else its first characters.

    What stands before an inner word start belongs to the passage, so every document that contains the passage has the
    gram at a word start too. The kind is the width, negative for first characters, which may stand anywhere.
    """
    def tagged(kind: Column, grams: Column) -> Column:
        return F.transform(F.array_distinct(grams), lambda g: F.struct(kind.cast("int").alias("kind"), g.alias("gram")))

    inner = [F.regexp_extract_all(passage, F.lit(rf"(?s)(?<=.){STARTS}(?=(.{{{w}}}))"), F.lit(1)) for w in GRAMS]
    first = F.substring(passage, 1, RUN)
    out = tagged(-F.char_length(first), F.array(first))
    for width, grams in reversed(list(zip(GRAMS, inner))):
        out = F.when(F.size(grams) > 0, tagged(F.lit(width), grams)).otherwise(out)
    return out


def document_grams(text: Column, kinds: list[int]) -> Column:
    """A document's own grams of the given kinds, each once."""
    def of(kind: int) -> Column:
        pattern = rf"(?s){STARTS}(?=(.{{{kind}}}))" if kind > 0 else rf"(?s)(?=(.{{{-kind}}}))"
        grams = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))
        return F.transform(grams, lambda g: F.struct(F.lit(kind).alias("kind"), g.alias("gram")))

    return F.concat(*[of(k) for k in kinds])


def passages_in(passages: DataFrame, docs: DataFrame, where: str | None = None) -> DataFrame:
    """item_id and doc_id where a document contains a passage character for character.

    Documents are taken apart once, into postings of the grams that passages have, a table in the folder ``where`` (a new
    one in the shared folder if not given). It says how frequent each gram is, and each passage is looked up by its
    rarest one; the texts of the few pairs that meet are then compared. Kinds of grams that no passage needs are not
    made. An empty passage is not searched for.
    """
    spark = docs.sparkSession
    left = passages.filter("text <> ''").select("item_id", F.col("text").alias("passage"))
    grams = left.select("item_id", "passage", F.explode(passage_grams(F.col("passage"))).alias("g")).select("item_id", "passage", "g.*")
    kinds = sorted(r["kind"] for r in grams.select("kind").distinct().collect())
    if not kinds:
        return left.select("item_id").crossJoin(docs.select("doc_id").limit(0))
    path = where or f"{work_dir(spark)}/postings"
    own = docs.select("doc_id", F.explode(document_grams(F.col("text"), kinds)).alias("g")).select("doc_id", "g.*")
    own.join(grams.select("kind", "gram").distinct(), ["kind", "gram"], "left_semi").write.parquet(path)
    postings = spark.read.parquet(path)
    counts = postings.groupBy("kind", "gram").agg(F.count(F.lit(1)).alias("n"))
    rarest = grams.join(counts, ["kind", "gram"], "left").groupBy("item_id", "passage").agg(F.min_by(F.struct("kind", "gram"), F.struct(F.coalesce("n", F.lit(0)), "kind", "gram")).alias("g"))
    pairs = postings.join(rarest.select("item_id", "passage", "g.*"), ["kind", "gram"]).select("doc_id", "item_id", "passage").distinct()
    both = pairs.join(docs.select("doc_id", "text"), "doc_id")
    return both.filter(F.contains("text", F.col("passage"))).select("item_id", "doc_id").distinct()


def outcome(candidates: Column, blocked: Column, least: int = 1) -> Column:
    """failed if nothing could be seen, no_item if a healthy page lacks the model: the two are not the same."""
    return F.when(blocked | (candidates < least), "failed").otherwise("no_item")
