"""URL filters by association rules: given rules first, then rules that FP-growth
mines from labelled URLs.

*Given rules.* A rule names a host and the start of a path (``example.org/es/``).
It fits a URL whose host is that host or a subdomain of it and whose path
starts with the rule's; of those that fit the longest wins, block before allow
among equals.

*Mined rules.* A URL becomes a set of tokens: scheme, host and its suffixes of
up to four labels, words of the host, path segments with runs of digits folded
to ``#``, file extension, query keys, presence of a fragment. Labelled URLs
with their label as one more item are the baskets of Spark's FP-growth. Kept
are the rules that conclude a label with at least ``min_confidence``,
``min_support`` (of all labelled URLs, and ``min_rows`` of them) and a lift
over ``min_lift``, unless a more general rule for the same label is at least
as confident. Tokens that all URLs hold tell nothing and are not mined; of
tokens that always come together one is. A basket mines with all its other
frequent tokens, none is cut; matching looks at all tokens.

*Matching* goes by an inverted index: each rule stands under its rarest token,
so a URL meets only rules of which it holds that token, and the rest of the
rule is compared in place. The surest rule wins (confidence, support, block
before allow); a URL that no rule fits gets the label most labelled URLs have
(allow when there are none). A URL's tokens and partial results stay in the
task that read it: one exchange of one narrow row a URL, whatever the host.

A NULL URL or one without ``://`` has empty host and path, no token and so the
common verdict. Repeated rows are judged each; a NULL label leaves its URL out
of the mining, an empty table gives an empty one. Other columns are ignored.
Everything runs as DataFrame operations and Spark's own FP-growth.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contract_lake.llm.common import written

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LABEL = "label="
#: The index is broadcast up to this size, else it is a shuffle join.
BROADCAST_BYTES = 16 << 20


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
    lower case; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def given_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of ``rules`` (verdict, ``host/path``)
    that fits, both NULL if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, name in sorted(rules, key=lambda r: (len(r[1]), r[0] == BLOCK)):  # later ones win
        own, slash, start = name.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + start)
        rule, verdict = F.when(fits, name).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def tokens_of(url: Column) -> Column:
    """The distinct tokens of a URL; none without ``://``."""
    host, path = host_of(url), path_of(url)
    # a port or user name is no part of a name
    name = F.regexp_replace(F.regexp_replace(host, r"^[^@]*@", ""), r":[0-9]*$", "")
    labels = F.split(name, r"\.")
    depth = F.least(F.lit(4), F.size(labels))
    suffixes = F.transform(F.sequence(F.lit(1), depth), lambda n: F.concat(F.lit("host:"), F.array_join(F.slice(labels, -n, n), ".")))
    words = F.transform(F.split(name, r"[.\-]"), lambda w: F.concat(F.lit("word:"), w))
    segments = F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), lambda s: F.concat(F.lit("path:"), F.regexp_replace(s, "[0-9]+", "#")))
    extension = F.regexp_extract(path, r"\.([A-Za-z]+)/?$", 1)
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda k: k != ""), lambda k: F.concat(F.lit("key:"), F.element_at(F.split(k, "=", 2), 1)))
    others = F.array(F.concat(F.lit("scheme:"), F.translate(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1), UPPER, LOWER)),
                     F.concat(F.lit("host:"), name),
                     F.when(extension != "", F.concat(F.lit("ext:"), extension)), F.when(url.contains("#"), "fragment"))
    return F.when(url.contains("://"), F.array_distinct(F.array_compact(F.concat(others, suffixes, words, segments, keys)))).otherwise(
        F.array().cast("array<string>"))


def baskets(labelled: DataFrame, min_support: float, min_rows: int) -> tuple[DataFrame, float]:
    """``items`` of each row of ``labelled`` (url, blocked) for FP-growth, its
    label among them, written once; and the support that means ``min_rows``."""
    rows = written(labelled.where("blocked IS NOT NULL").select(
        F.monotonically_increasing_id().alias("row"), "blocked", tokens_of(F.col("url")).alias("tokens")), "urlrules-labelled")
    total = rows.agg(F.count("*").alias("n")).first()
    single = rows.select("row", F.explode("tokens").alias("token"))
    support = max(min_support, min(1.0, min_rows / max(1, total.n)))
    # Frequent tokens only: fewer than (tokens a URL) / support rows.
    telling = (single.groupBy("token").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("row")).alias("rows"))
               .where((F.col("n") >= support * total.n) & (F.col("n") < total.n))
               .groupBy("n", "rows").agg(F.min("token").alias("token")).select("token"))
    label = F.concat(F.lit(LABEL), F.when(F.col("blocked"), BLOCK).otherwise(ALLOW))
    chosen = single.join(telling, "token").groupBy("row").agg(F.collect_list("token").alias("tokens"))
    items = F.concat(F.coalesce("tokens", F.array().cast("array<string>")), F.array("label")).alias("items")
    return written(rows.select("row", label.alias("label")).join(chosen, "row", "left").select(items), "urlrules-baskets"), support


def mined_rules(labelled: DataFrame, min_support: float = 0.005, min_confidence: float = 0.5, min_lift: float = 1.05,
                min_rows: int = 20) -> DataFrame:
    """``items`` (sorted), ``pivot`` (the rarest of them), ``verdict``,
    ``confidence``, ``support``, ``lift`` of the rules kept, from ``labelled``
    (url, blocked boolean)."""
    found, support = baskets(labelled, min_support, min_rows)
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(found)
    rules = (model.associationRules.where(F.element_at("consequent", 1).startswith(LABEL) & (F.col("lift") >= min_lift))
             .select(F.sort_array("antecedent").alias("items"), F.substring(F.element_at("consequent", 1), len(LABEL) + 1, 8).alias("verdict"),
                     "confidence", "support", "lift"))
    rarity = model.freqItemsets.where(F.size("items") == 1).select(F.element_at("items", 1).alias("pivot"), "freq")
    rules = written(rules, "urlrules-mined")
    pivots = (rules.select("items", "verdict", F.explode("items").alias("pivot")).join(rarity, "pivot")
              .groupBy("items", "verdict").agg(F.min_by("pivot", F.struct("freq", "pivot")).alias("pivot")))
    rules = written(rules.join(pivots, ["items", "verdict"]), "urlrules-pivoted")
    # A rule goes when one with fewer of its tokens is as confident; that one's pivot is among its tokens.
    general = rules.select("pivot", "verdict", F.col("items").alias("fewer"), F.col("confidence").alias("surer"))
    special = rules.select("items", "verdict", "confidence", F.explode("items").alias("pivot"))
    idle = (special.join(general, ["pivot", "verdict"])
            .where((F.size("fewer") < F.size("items")) & (F.col("surer") >= F.col("confidence")) & (F.size(F.array_except("fewer", "items")) == 0))
            .select("items", "verdict").distinct())
    return written(rules.join(idle, ["items", "verdict"], "left_anti"), "urlrules-rules")


def judged(pages: DataFrame, labelled: DataFrame, rules: list[tuple[str, str]], **mining) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` of every row of
    ``pages`` (page_id, url), and the mined rule that decided: ``mined``
    (its tokens), ``confidence``, ``support``."""
    labelled = labelled.select("url", "blocked")
    found = mined_rules(labelled, **mining)
    common = labelled.agg(F.count_if("blocked").alias("blocked"), F.count("blocked").alias("n")).first()
    usual = BLOCK if 2 * common.blocked > common.n else ALLOW
    # One row a pivot: at most as many as frequent tokens.
    index = found.groupBy(F.col("pivot").alias("token")).agg(F.collect_list(F.struct("confidence", "support", "verdict", "items")).alias("rules"))
    size = found.agg(F.sum(F.lit(64) + F.length(F.array_join("items", " ")) + 24 * F.size("items"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        index = F.broadcast(index)
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select(F.monotonically_increasing_id().alias("row"), F.col("page_id").cast("long"), F.col("url").cast("string"))
    rule, verdict = given_rule(F.col("host"), F.col("path"), rules)
    rows = (rows.withColumns({"host": host, "path": path}).withColumns({"rule": rule, "said": verdict})
            .withColumn("tokens", F.when(F.col("rule").isNull(), tokens_of(F.col("url"))))
            .select("row", "page_id", "host", "path", "rule", "said", "tokens", F.explode_outer("tokens").alias("token")))
    fitting = F.filter("rules", lambda r: F.size(F.array_except(r["items"], F.col("tokens"))) == 0)
    best = F.array_max(F.transform(fitting, lambda r: F.struct(
        r["confidence"].alias("confidence"), r["support"].alias("support"), (r["verdict"] == BLOCK).alias("block"), r["items"].alias("items"))))
    return (rows.join(index, "token", "left").select("row", "page_id", "host", "path", "rule", "said", best.alias("best"))
            .groupBy("row", "page_id", "host", "path", "rule", "said").agg(F.max("best").alias("best"))
            .select("page_id", "host", "path", "rule",
                    F.coalesce("said", F.when(F.col("best.block"), BLOCK).when(F.col("best").isNotNull(), ALLOW), F.lit(usual)).alias("verdict"),
                    F.array_join("best.items", " ").alias("mined"), F.col("best.confidence").alias("confidence"), F.col("best.support").alias("support")))


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``url``, ``blocked`` of the pages that ``labels`` cover: a page's path
    names its document by number. A document of quality 0 or a toxic one is to
    be blocked; with rows that disagree about a document, block counts."""
    said = (labels.groupBy(F.col("doc_id").cast("long").alias("doc_id"))
            .agg(F.max((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).alias("blocked"),
                 (F.count("quality") + F.count("toxic")).alias("n")).where("n > 0 AND doc_id IS NOT NULL").drop("n"))
    number = F.regexp_extract(path_of(F.col("url")), r"/([0-9]{1,18})(?:[./]|$)", 1).try_cast("long")
    return pages.select(F.col("url").cast("string"), number.alias("doc_id")).join(said, "doc_id").select("url", "blocked")
