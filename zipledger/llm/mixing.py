"""Mixing sources to target weights by hierarchical budgeting (DataFrame functions only).

Method: the token budget goes down a tree of levels (domain, language, source). At each node the children
share by weight; a child that can't use its share (its capacity is its tokens times ``max_epochs``) keeps
its capacity and the rest of the share goes to its siblings, again by weight, so a shortage leaves a family
only if the whole family is short: then the parent's own capacity binds one level up. The water level of a family
is found in one window over its children ordered by capacity per weight, in exact integers. Each leaf then takes
whole epochs and, for the rest, the longest prefix of the next epoch's order that fits; an epoch's order is
the md5 of (seed, epoch, id).

Scale: the tree has one row per leaf. Documents are ordered by one distributed sort over all leaves with
running totals (no window over a leaf), so a source with a third of all rows is spread over range
partitions like any other rows; only ids, token counts and levels are sorted. Tables with one row a leaf are broadcast while
their counted rows are at most ``broadcast_leaves``; beyond that each leaf's rows are dealt over ``SALTS`` tasks, so a hot leaf is
split either way.

Defined results: a token is a word (run of ``[^\\x20\\x09-\\x0D]``); documents without one are never selected; a null
level value is the node ``(none)``; a weight not given is 1, a weight of 0 or less selects nothing and adds
no capacity to its ancestors; shares are rounded down to whole tokens. A null id is an id like any other. Repeated rows (same id, text, levels) count once and
each come back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import with_global_rank
from .common import stage, words

DOMAIN_WEIGHTS = {"d0": 5, "d1": 3, "d2": 2}
LANGUAGE_WEIGHTS = {"en": 4, "de": 3, "fr": 2, "es": 1}


def domain_of(source: Column) -> Column:
    """The domain of a source of these tables: its number modulo 3 (no number: d0)."""
    number = F.nullif(F.regexp_extract(F.coalesce(source, F.lit("")), "([0-9]{1,9})$", 1), F.lit(""))
    return F.concat(F.lit("d"), (F.coalesce(number.cast("bigint"), F.lit(0)) % 3).cast("string"))


def _weight(col: Column, weights: dict[str, int]) -> Column:
    if not weights:
        return F.lit(1).cast("long")
    table = F.create_map(*[F.lit(x) for k, v in sorted(weights.items()) for x in (k, int(v))])
    return F.coalesce(F.try_element_at(table, col), F.lit(1)).cast("long")


def _share(children: DataFrame, parent: list[str]) -> DataFrame:
    """children: parent columns, name, cap, weight, budget (the parent's) -> with ``alloc``."""
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    order = Window.partitionBy(*parent).orderBy(F.col("cap") / F.col("weight"), "name")
    family = Window.partitionBy(*parent)
    marked = (children.where("weight > 0")
              .withColumn("before", F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)))
              .withColumn("rest_weight", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
              .withColumn("full", wide("cap") * wide("rest_weight") <= (wide("budget") - F.coalesce(wide("before"), F.lit(0))) * wide("weight")))
    left = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(family), F.lit(0))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(family)
    return (marked.withColumn("left", left).withColumn("open_weight", open_weight)
            .withColumn("alloc", F.when(F.col("full"), F.col("cap")).otherwise(
                F.floor(wide("left") * wide("weight") / wide("open_weight")).cast("long")))
            .drop("before", "rest_weight", "full", "left", "open_weight"))


def budgets(leaves: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], budget: Column | int, max_epochs: int) -> DataFrame:
    """leaves: level columns and ``tokens``. Adds ``alloc``: the tokens each leaf is to give."""
    chosen = F.lit(True)
    for level in levels:
        chosen &= _weight(F.col(level), weights.get(level, {})) > 0
    caps = leaves.withColumn("cap", F.when(chosen, F.col("tokens") * max_epochs).otherwise(0).cast("long"))
    total = caps.agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens")).withColumn("root", F.lit(0))
    wanted = budget if isinstance(budget, Column) else F.lit(int(budget)).cast("long")
    parents = total.select("root", F.least(F.coalesce(wanted, F.lit(0)), F.coalesce("cap", F.lit(0))).cast("long").alias("budget"))
    caps = caps.withColumn("root", F.lit(0))
    path = ["root"]
    for level in levels:
        children = caps.groupBy(*path, level).agg(F.sum("cap").alias("cap")).withColumn("weight", _weight(F.col(level), weights.get(level, {})))
        shared = _share(children.join(parents, path).withColumn("name", F.col(level)), path)
        path = [*path, level]
        parents = shared.select(*path, F.col("alloc").alias("budget"))
    return caps.join(parents, path).select(*levels, "tokens", F.col("budget").alias("alloc"))


BROADCAST_LEAVES = 100_000
SALTS = 64


def _with_leaf(rows: DataFrame, leaf: DataFrame, names: list[str], few: bool) -> DataFrame:
    """``rows`` with the columns of ``leaf`` (one row a leaf); ``few``: its size is known to be within the broadcast bound."""
    if few:
        return rows.join(F.broadcast(leaf), names)
    salt = "salt"
    while salt in rows.columns + leaf.columns:
        salt += "_"
    dealt = rows.withColumn(salt, F.pmod(F.xxhash64("doc", "text_key"), F.lit(SALTS)).cast("int"))
    return dealt.join(leaf.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), [*names, salt]).drop(salt)


def select_mix(docs: DataFrame, levels: dict[str, Column], weights: dict[str, dict[str, int]], budget: Column | int, max_epochs: int = 2,
               seed: int = 7, id_col: str = "doc_id", text_col: str = "text", broadcast_leaves: int = BROADCAST_LEAVES) -> DataFrame:
    """(doc, text_key, <levels>, n_tokens, epoch): one row per document and epoch that takes it. ``budget`` is a number of
    tokens or a Column over ``tokens`` (all tokens there are)."""
    names = list(levels)
    rows = stage(docs.select(F.col(f"`{id_col}`").alias("doc"), F.xxhash64(F.col(f"`{text_col}`")).alias("text_key"),
                             *[F.coalesce(c.cast("string"), F.lit("(none)")).alias(n) for n, c in levels.items()],
                             F.size(words(F.col(f"`{text_col}`"))).cast("long").alias("n_tokens")).where("n_tokens > 0").distinct(), "mix-rows")
    leaves = rows.groupBy(*names).agg(F.sum("n_tokens").alias("tokens"))
    plan = stage(budgets(leaves, names, weights, budget, max_epochs).where("alloc > 0").select(
        *names, F.expr("alloc div tokens").cast("int").alias("full"), (F.col("alloc") % F.col("tokens")).alias("rest")), "mix-plan")
    few = plan.count() <= broadcast_leaves
    planned = _with_leaf(rows, plan, names, few)
    cols = ["doc", "text_key", *names, "n_tokens"]
    whole = planned.where("full > 0").select(*cols, F.explode(F.sequence(F.lit(0), F.col("full") - 1)).alias("epoch"))
    key = F.md5(F.concat_ws(":", F.lit(seed), F.col("full"), F.coalesce(F.col("doc").cast("string"), F.lit("null"))))
    part = planned.where("rest > 0").select(*cols, "full", "rest", key.alias("order_key"))
    part = with_global_rank(part, [F.col(c) for c in (*names, "order_key", "doc", "n_tokens", "text_key")], "running", weight=F.col("n_tokens"))
    base = part.groupBy(*names).agg(F.min(F.col("running") - F.col("n_tokens")).alias("base"))
    prefix = _with_leaf(part, base, names, few).where(F.col("running") - F.col("base") <= F.col("rest")).select(*cols, F.col("full").alias("epoch"))
    return whole.union(prefix)


def corpus_mix(docs: DataFrame) -> DataFrame:
    """The production mix of these tables: 60 per cent of all tokens, two epochs at most."""
    levels = {"domain": domain_of(F.col("source")), "lang": F.col("lang"), "source": F.col("source")}
    return select_mix(docs, levels, {"domain": DOMAIN_WEIGHTS, "lang": LANGUAGE_WEIGHTS}, F.expr("tokens * 3 div 5"))


def op7_mix_sources(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    return corpus_mix(docs).select(F.col("doc").alias("doc_id"), "domain", "lang", "source", "n_tokens", "epoch")


def _share_sql(name: str, path: str, level: str, weight: str, parents: str) -> str:
    using = f"({path})"
    return f"""
{name}_c AS (SELECT {path}, {level}, sum(cap)::HUGEINT AS cap, {weight} AS weight FROM leaves GROUP BY ALL),
{name}_m AS (
  SELECT *, cap * sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
            <= (budget - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight AS is_full
  FROM {name}_c JOIN {parents} USING {using}
  WINDOW o AS (PARTITION BY {path} ORDER BY cap::DOUBLE / weight, {level})),
{name} AS (
  SELECT {path}, {level}, CASE WHEN is_full THEN cap ELSE
         ((budget - coalesce(sum(cap) FILTER (is_full) OVER f, 0)) * weight) // (sum(weight) FILTER (NOT is_full) OVER f) END AS budget
  FROM {name}_m WINDOW f AS (PARTITION BY {path}))"""


OP7_SQL = (r"""
WITH rows_ AS (
  SELECT doc_id, 'd' || (coalesce(nullif(regexp_extract(coalesce(source, ''), '([0-9]{1,9})$', 1), '')::BIGINT, 0) % 3) AS domain,
         coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
         len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS n_tokens FROM documents),
live AS (SELECT * FROM rows_ WHERE n_tokens > 0),
leaves AS (SELECT 0 AS root, domain, lang, source, sum(n_tokens)::HUGEINT AS tokens, 2 * sum(n_tokens)::HUGEINT AS cap FROM live GROUP BY ALL),
top AS (SELECT 0 AS root, least(sum(tokens) * 3 // 5, sum(cap)) AS budget FROM leaves),"""
           + _share_sql("d", "root", "domain", "CASE domain WHEN 'd0' THEN 5 WHEN 'd1' THEN 3 WHEN 'd2' THEN 2 ELSE 1 END", "top") + ","
           + _share_sql("l", "root, domain", "lang", "CASE lang WHEN 'en' THEN 4 WHEN 'de' THEN 3 WHEN 'fr' THEN 2 ELSE 1 END", "d") + ","
           + _share_sql("s", "root, domain, lang", "source", "1", "l") + r""",
plan AS (SELECT domain, lang, source, (budget // tokens)::INT AS is_whole, (budget % tokens)::BIGINT AS rest FROM s JOIN leaves USING (domain, lang, source)),
part AS (SELECT live.*, is_whole, rest, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('7:' || is_whole || ':' || doc_id), doc_id
         ROWS UNBOUNDED PRECEDING) AS running FROM live JOIN plan USING (domain, lang, source))
SELECT doc_id, domain, lang, source, n_tokens, unnest(range(is_whole))::INT AS epoch FROM part
UNION ALL SELECT doc_id, domain, lang, source, n_tokens, is_whole FROM part WHERE rest > 0 AND running <= rest
""")
