"""URL filters: suffix and prefix rules first, association rules for the rest.

Written rules name a host and a path. A rule fits its host and all subdomains if the url's path
starts with the rule's; the longest decides.

Where no rule fits, mined rules do. FP-growth finds the token combinations of labelled urls that
are frequent enough; a combination becomes a rule if blocked urls make up enough of the labelled
urls that have it. Tokens that occur in exactly the same urls are one item, so templates and nested hosts
do not multiply combinations, and a rule's body has all of them. A rule is dropped if a shorter one
that it contains is at least as confident.
Matching uses an inverted index: each rule is filed under its rarest token, a url's tokens look up
the rules filed under them, and a rule matches if the url has all of its tokens.

All of it is DataFrame operations; there is no Python on the executors.

Cases: a null url, or one without ``://``, has an empty host and path and no tokens, fits no rule
and is allowed; a written rule's path must be there (an empty path does not start with ``/``);
repeated rows each have a verdict; null labels are no labels; without labels, or where no
combination is frequent, nothing is mined and the rest is allowed; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

#: (host, path, verdict) of the production rules.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: A combination must be in this share of the labelled urls, and in this many of them.
SUPPORT = 0.005
LEAST_ROWS = 10
CONFIDENCE = 0.6
BLOCKED = "label=block"
#: Mined rules beyond which the index is joined by a shuffle.
BROADCAST_RULES = 10_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: F.Column) -> F.Column:
    """From after the first ``://`` to ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path(url: F.Column) -> F.Column:
    """From the host's end to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def written_rule(rules=RULES) -> tuple[F.Column, F.Column]:
    """(rule, verdict) of the longest written rule that fits columns ``host`` and ``path``."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):  # the longest is tested first
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def tokens(url: str = "url") -> F.Column:
    """Distinct tokens: the suffixes of the host, the words of the path
    without numbers, the names of the query's parameters, and the scheme."""
    labels = F.split("host", r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), F.least(n, F.lit(8))), lambda i: F.concat(F.lit("h:"), F.array_join(F.slice(labels, -i, i), ".")))
    pieces = F.filter(F.split(F.lower("path"), r"[^\p{L}]+"), lambda w: w != "")
    query = F.regexp_extract_all(F.regexp_extract(F.col(url), r"\?([^#]*)", 1), F.lit(r"([^&=]+)(=[^&]*)?"), 1)
    rest = F.concat(
        F.transform(pieces, lambda w: F.concat(F.lit("p:"), w)),
        F.transform(query, lambda w: F.concat(F.lit("q:"), w)),
        F.array(F.concat(F.lit("s:"), F.lower(F.regexp_extract(F.col(url), r"^([^:]*)://", 1)))),
    )
    return F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(suffixes, rest)))


def parsed(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, items)."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    rows = rows.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    return rows.withColumn("items", F.coalesce(tokens(), F.array().cast("array<string>")))


def classes(baskets: DataFrame, least: int) -> DataFrame:
    """(token, name, members): the tokens of at least ``least`` baskets (row, item), and with each the
    tokens that occur in exactly the same baskets. Such tokens are one item to the miner: a
    template of k words gives one item, not 2 ** k combinations, and a host and the suffixes that
    only it has are one item as well. The table is small: a token is in a share of
    least / baskets of all baskets, so there are at most (items of a basket / share) tokens."""
    mark = F.xxhash64("row")
    uses = baskets.groupBy("item").agg(F.count("*").alias("n"), F.bit_xor(mark).alias("x"), F.sum(F.shiftright(mark, 24)).alias("s"))
    same = uses.filter(F.col("n") >= least).groupBy("n", "x", "s").agg(F.sort_array(F.collect_list("item")).alias("members"))
    return same.select(F.explode("members").alias("item"), F.col("members")[0].alias("name"), "members")


def mine(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """(items, confidence, support): the rules mined from rows (items, blocked), pruned; stored.

    Bodies are closed under tokens that always occur together (:func:`classes`)."""
    numbered = labelled.select(F.monotonically_increasing_id().alias("row"), "items", "blocked").filter(F.size("items") > 0)
    rows = shared.stored(numbered, "labelled_urls")
    n = max(1, rows.count())
    support = min(1.0, max(support, LEAST_ROWS / n))
    items = rows.select("row", F.explode(F.array_distinct("items")).alias("item"))
    known = shared.stored(classes(items, math.ceil(support * n - 1e-9)), "token_classes")
    baskets = items.join(F.broadcast(known), "item").groupBy("row").agg(F.collect_set("name").alias("names"))
    baskets = baskets.join(rows.select("row", "blocked"), "row")
    basket = F.when(F.col("blocked"), F.concat("names", F.array(F.lit(BLOCKED)))).otherwise(F.col("names"))
    baskets = shared.stored(baskets.select(basket.alias("items")), "baskets")
    # The share is of all labelled rows; rows whose tokens are all rare are not in the baskets.
    share = min(1.0, support * n / max(1, baskets.count()))
    sets = FPGrowth(itemsCol="items", minSupport=share).fit(baskets).freqItemsets
    sets = shared.stored(sets.select(F.sort_array("items").alias("items"), "freq"), "itemsets")
    bodies = sets.filter(~F.array_contains("items", BLOCKED)).withColumnRenamed("freq", "n")
    heads = sets.filter(F.array_contains("items", BLOCKED) & (F.size("items") > 1))
    heads = heads.select(F.array_remove("items", BLOCKED).alias("items"), "freq")
    found = heads.join(bodies, "items").select("items", (F.col("freq") / F.col("n")).alias("confidence"), F.col("freq").alias("support"))
    found = shared.stored(found.filter(F.col("confidence") >= confidence), "rules")
    # A rule goes if it holds one item more than another that is as confident.
    less = found.select(
        "items", "confidence", F.explode(F.transform("items", lambda x: F.array_remove("items", x))).alias("shorter")
    ).filter(F.size("shorter") > 0)
    reached = found.select(F.col("items").alias("shorter"), F.col("confidence").alias("reached"))
    worse = less.join(reached, "shorter").filter("reached >= confidence").select("items").distinct()
    pruned = found.join(worse, "items", "left_anti").select("items", "confidence", "support", F.explode("items").alias("name"))
    whole = known.filter("item = name").select("name", "members")
    pruned = pruned.join(F.broadcast(whole), "name").groupBy("items").agg(
        F.sort_array(F.flatten(F.collect_list("members"))).alias("closed"), F.first("confidence").alias("confidence"), F.first("support").alias("support")
    )
    out = shared.stored(pruned.select(F.col("closed").alias("items"), "confidence", "support"), "pruned_rules")
    for done in (rows, known, baskets, sets, found):
        shared.discard(done)
    return out


def matches(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The keys of the rows (key, items) that a rule matches, by the rules' rarest tokens."""
    uses = rules.select(F.explode("items").alias("token")).groupBy("token").count()
    filed = rules.select(F.xxhash64("items").alias("rule"), "items", F.explode("items").alias("token")).join(uses, "token")
    index = filed.groupBy("rule").agg(F.min(F.struct("count", "token")).alias("rarest"), F.first("items").alias("rule_items"))
    index = index.select(F.col("rarest.token").alias("token"), "rule_items")
    if rules.count() <= BROADCAST_RULES:
        index = F.broadcast(index)
    looked = urls.select("key", "items", F.explode("items").alias("token")).join(index, "token")
    return looked.filter(F.size(F.array_except("rule_items", "items")) == 0).select("key").distinct()


def verdicts(
    pages: DataFrame, labels: DataFrame, rules=RULES, support: float = SUPPORT, confidence: float = CONFIDENCE,
    id_col: str = "page_id", url_col: str = "url", label_id: str = "doc_id", bad: str = "toxic = 1 or quality = 0",
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row. ``bad`` says which labels mean block."""
    rows = parsed(pages, id_col, url_col)
    known = labels.filter(f"({bad}) is not null").groupBy(F.col(label_id).cast("long").alias("page_id"))
    known = known.agg(F.max(F.expr(bad)).alias("blocked"))
    mined = mine(rows.select("page_id", "items").join(known, "page_id").select("items", "blocked"), support, confidence)
    rule, verdict = written_rule(rules)
    out = rows.withColumns({"rule": rule, "written": verdict, "key": F.array_join("items", "\n")})
    if mined.limit(1).count():
        # Urls repeat their tokens: each distinct set is matched once.
        flagged = matches(out.select("key", "items").distinct(), mined).withColumn("mined", F.lit("block"))
        out = out.join(flagged, "key", "left").withColumn("written", F.coalesce("written", "mined"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("written", F.lit("allow")).alias("verdict"))
