"""Search in a catalog: exact matches, or else the best fuzzy ones."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.maps import omit
from ..functions.names import fuzzy_score
from ..operators.graph import closure, reverse
from ..operators.joins import first_match
from ..operators.order import exact_else_fuzzy

LIMIT = 20
SUFFIX = ".admin.example.com"
# What an inspection of fields can show beside the basics.
DETAILS = ("fieldsets", "validators", "appearance", "default_value")


def find_models(models: DataFrame, query: str) -> DataFrame:
    """Models (id, api_key, name, ord) whose key, id or name is the query, or else all that match fuzzily, best first."""
    q = F.lit(query)
    exact = (F.col("api_key") == q) | (F.col("id") == q) | (F.col("name") == q)
    score = F.greatest(fuzzy_score(F.lower(q), F.lower("api_key")), fuzzy_score(F.lower(q), F.lower("name")))
    return exact_else_fuzzy(models, exact, score, None, "ord")


def find_projects(projects: DataFrame, query: str | None, limit: int = LIMIT) -> DataFrame:
    """Projects (id, name, domain, ord) by id, or name or domain whatever the case; else the best ``limit``. Without a query the first ones."""
    if not query:
        return projects.orderBy("ord").limit(limit)
    q = F.lower(F.lit(query))
    exact = (F.col("id") == query) | (F.lower("name") == q) | (F.lower("domain") == q)
    score = F.greatest(fuzzy_score(q, F.lower("name")), fuzzy_score(q, F.lower("domain")))
    return exact_else_fuzzy(projects, exact, score, limit, "ord")


def in_workspace(rows: DataFrame, workspace: str) -> DataFrame:
    """Rows of one workspace, named by type, id or name; personal ones also by their owner's mail."""
    w = F.lower(F.lit(workspace))
    personal = (F.col("workspace_type") == "personal") & (w.isin("personal", "personal account") | (F.lower("owner") == w))
    return rows.where(personal | ((F.col("workspace_type") == "organization") & ((F.col("workspace_id") == workspace) | (F.lower("workspace_name") == w))))


def of_sort(models: DataFrame, sort: str = "all") -> DataFrame:
    """All models, or only those that are blocks (``blocks_only``) or aren't (``models_only``)."""
    wanted = {"all": F.lit(True), "blocks_only": F.col("modular_block"), "models_only": ~F.col("modular_block")}
    return models.where(wanted[sort])


def primary(environments: DataFrame) -> DataFrame:
    """The first environment (id, is_primary, ord) that is the primary one."""
    return environments.where("is_primary").orderBy("ord").limit(1)


def projects_of(workspaces: DataFrame, sites: DataFrame) -> DataFrame:
    """(id, name, domain, workspace, workspace_ord, ord): the sites of every workspace that can be used, that is with a token, each once, in the first workspace that has it."""
    rows = sites.where(F.coalesce(F.col("access_token"), F.lit("")) != "").join(workspaces.select("workspace_id", F.col("name").alias("workspace"), F.col("ord").alias("workspace_ord")), "workspace_id")
    own = first_match(rows, "id", "workspace_ord", "ord")
    domain = F.coalesce(F.nullif("domain", F.lit("")), F.concat(F.coalesce(F.col("subdomain"), F.col("id").cast("string")), F.lit(SUFFIX)))
    return own.select("id", "name", domain.alias("domain"), "workspace", "workspace_ord", "ord")


def usable_workspaces(workspaces: DataFrame, sites: DataFrame) -> DataFrame:
    """Workspaces with a site that can be used, and how many they have."""
    per = sites.where(F.coalesce(F.col("access_token"), F.lit("")) != "").groupBy("workspace_id").agg(F.count("*").alias("n_sites"))
    return workspaces.join(per, "workspace_id")


def details(level: str, wanted: tuple[str, ...] = ()) -> set[str]:
    """What an inspection shows: the details that are asked for, or else those of the level."""
    return set(wanted) or (set(DETAILS) if level == "complete" else set())


def shown(fields: DataFrame, which: set[str]) -> DataFrame:
    """Fields (id, attributes, relationships) with their details only where asked for: the model never, the place only with fieldsets."""
    gone = [d for d in DETAILS if d != "fieldsets" and d not in which] + ["deep_filtering_enabled", "appeareance"] + ([] if "fieldsets" in which else ["position"])
    links = ["item_type"] + ([] if "fieldsets" in which else ["fieldset"])
    return fields.withColumns({"attributes": omit(F.col("attributes"), *gone), "relationships": omit(F.col("relationships"), *links)})


def model_shown(models: DataFrame) -> DataFrame:
    """Models without the lists of their parts."""
    return models.withColumn("relationships", omit(F.col("relationships"), "fields", "fieldsets", "singleton_item"))


def suggestions(names: DataFrame, column: str, prefix: str = "", limit: int = LIMIT) -> DataFrame:
    """The first names in order, each once, of those with a prefix."""
    return names.select(column).distinct().where(F.startswith(column, F.lit(prefix))).orderBy(column).limit(limit)


def nested(models: DataFrame, fields: DataFrame, fieldsets: DataFrame) -> DataFrame:
    """``models`` (id, ...) with their fields and fieldsets (owner, position, id, ...) as arrays in the order of positions."""
    out = models
    for name, rows in (("fields", fields), ("fieldsets", fieldsets)):
        own = [c for c in rows.columns if c != "owner"]
        lists = rows.groupBy("owner").agg(F.array_sort(F.collect_list(F.struct("position", *[c for c in own if c != "position"]))).alias(name))
        out = out.join(lists.withColumnRenamed("owner", "id"), "id", "left").withColumn(name, F.coalesce(name, F.slice(F.array(F.struct(*[F.lit(None).cast(dict(rows.dtypes)[c]).alias(c) for c in ("position", *[c for c in own if c != "position"])])), 1, 0)))
    return out


def contains(text: str | Column, term: str) -> Column:
    """Whether a term occurs, whatever the case."""
    return F.contains(F.lower(text), F.lower(F.lit(term)))


def with_related(found: DataFrame, blocks: DataFrame, references: DataFrame, nested: bool = False, referenced: bool = False, embedding: bool = False) -> DataFrame:
    """(node, reason): the models found and, where asked for, nested blocks, models they refer to and models that embed them; each once, by its first reason."""
    start = found.select("node")
    parts = [start.withColumn("reason", F.lit(0))]
    inner = closure(start, blocks).select("node") if nested or referenced else start
    if nested:
        parts.append(inner.withColumn("reason", F.lit(1)))
    if referenced:
        parts.append(inner.join(references, F.col("node") == F.col("src")).select(F.col("dst").alias("node"), F.lit(2).alias("reason")))
    if embedding:
        parts.append(closure(start, reverse(blocks)).select("node", F.lit(3).alias("reason")))
    return reduce(DataFrame.unionByName, parts).groupBy("node").agg(F.min("reason").alias("reason"))
