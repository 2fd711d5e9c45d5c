"""Import of a blog: its collections as rows of five fixed models, with keys looked up and addresses of assets rewritten."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.names import titleized
from ..operators.joins import resolve, resolve_list
from ..operators.rewrite import rewrite as rewrite_texts

# The models in the order in which they are made, and their fields (key: type), a slug following the first field.
TARGETS = {
    "wp_tag": {"name": "string", "slug": "slug"},
    "wp_category": {"name": "string", "slug": "slug", "description": "text"},
    "wp_author": {"name": "string", "slug": "slug", "url": "string", "description": "text"},
    "wp_page": {"title": "string", "slug": "slug", "excerpt": "text", "content": "text", "featured_media": "file", "author": "link"},
    "wp_article": {"title": "string", "slug": "slug", "excerpt": "text", "content": "text", "featured_media": "file", "author": "link", "categories": "links", "tags": "links"},
}
# Labels and models of the fields that aren't named after their key or point to another model.
LABELS = {"featured_media": "Main image"}
POINTS_TO = {"author": "wp_author", "categories": "wp_category", "tags": "wp_tag"}
TOOLBAR = ("format", "bold", "italic", "strikethrough", "ordered_list", "unordered_list", "quote", "table", "link", "image", "show_source")


def target_fields(models: DataFrame) -> DataFrame:
    """(site, model, id, position, api_key, label, field_type, validators, appearance): the fields to make in the models (site, api_key, id) of each site."""
    rows = [(m, n, k, t, LABELS.get(k), POINTS_TO.get(k), next(iter(fields))) for m, fields in TARGETS.items() for n, (k, t) in enumerate(fields.items())]
    table = models.sparkSession.createDataFrame(rows, "model string, position int, api_key string, field_type string, own string, points_to string, first string")
    out = models.select("site", F.col("api_key").alias("model"), "id").join(F.broadcast(table), "model")
    out = out.join(models.select("site", F.col("api_key").alias("points_to"), F.col("id").alias("other")), ["site", "points_to"], "left")
    other = lambda name: F.concat(F.lit(f'{{"{name}":{{"item_types":["'), "other", F.lit('"],"on_publish_with_unpublished_references_strategy":"publish_references"}}'))
    validators = (
        F.when(F.col("field_type") == "slug", F.concat(F.lit('{"slug_title_field":{"title_field_id":"'), "id", F.lit("."), "first", F.lit('"}}')))
        .when(F.col("field_type") == "link", other("item_item_type")).when(F.col("field_type") == "links", other("items_item_type")).otherwise("{}")
    )
    editor = '{"editor":"wysiwyg","parameters":{"toolbar":["' + '","'.join(TOOLBAR) + '"]},"addons":[]}'
    label = F.coalesce("own", titleized(F.col("api_key")))
    return out.select("site", "model", "id", "position", "api_key", label.alias("label"), "field_type", validators.alias("validators"), F.when(F.col("field_type") == "text", editor).alias("appearance"))


def own_models(models: DataFrame) -> DataFrame:
    """The models that an import makes, so that another one can destroy them first."""
    return models.where(F.col("api_key").isin(*TARGETS))


def tags(rows: DataFrame) -> DataFrame:
    return rows.select("id", "name", "slug")


def categories(rows: DataFrame) -> DataFrame:
    return rows.select("id", "name", "slug", "description")


def authors(rows: DataFrame) -> DataFrame:
    return rows.select("id", "name", "slug", "url", "description")


def category_parents(rows: DataFrame, made: DataFrame) -> DataFrame:
    """(id, parent_id): new ids of the categories that have a parent (0 and null are none), by ``made`` (source, id)."""
    children = rows.where(F.coalesce(F.col("parent") != 0, F.lit(False))).select(F.col("id").alias("source"), "parent")
    own = children.join(made, "source")
    return own.join(made.select(F.col("source").alias("parent"), F.col("id").alias("parent_id")), "parent", "left").select("id", "parent_id")


Rewrite = Callable[[Column], Column] | DataFrame


def pages(rows: DataFrame, authors_made: DataFrame, uploads: DataFrame, rewrite: Rewrite) -> DataFrame:
    """Target rows of pages (id, title, slug, content, excerpt, author, date, featured_media, status; texts as structs with rendered).

    An author that isn't known is null. A featured asset takes the title along; 0 and null are none. ``rewrite`` is a table of
    pairs (old, new, ord) that the texts are rewritten by, whatever their case, or a function that is applied to them.
    """
    of = (lambda c: c) if isinstance(rewrite, DataFrame) else rewrite
    out = resolve(rows, authors_made.select("source", F.col("id").alias("author_id")), "author", "source", "author_id")
    out = resolve(out, uploads.select("source", F.col("id").alias("upload_id")), "featured_media", "source", "upload_id")
    title = F.col("title.rendered")
    image = F.when(F.coalesce(F.col("featured_media") != 0, F.lit(False)), F.struct("upload_id", title.alias("title"), title.alias("alt"), F.create_map().cast("map<string,string>").alias("custom_data")))
    out = out.select(
        "id", title.alias("title"), "slug", of(F.col("content.rendered")).alias("content"), of(F.col("excerpt.rendered")).alias("excerpt"), F.col("author_id").alias("author"), image.alias("featured_media"),
        F.col("date").alias("created_at"), F.col("date").alias("first_published_at"), F.when(F.col("status") == "publish", "published").otherwise("draft").alias("status"),
    )
    return rewrite_texts(out, ["content", "excerpt"], rewrite) if isinstance(rewrite, DataFrame) else out


def articles(rows: DataFrame, authors_made: DataFrame, categories_made: DataFrame, tags_made: DataFrame, uploads: DataFrame, rewrite: Rewrite) -> DataFrame:
    """Pages with their categories and tags: lists keep their order, and an unknown key stays as a hole."""
    out = pages(rows, authors_made, uploads, rewrite)
    for name, made in (("categories", categories_made), ("tags", tags_made)):
        out = out.join(resolve_list(rows.select("id", name), "id", name, made.withColumnRenamed("id", "__new"), "source", "__new", holes=True), "id", "left")
    return out


def rewritten_urls(media: DataFrame, uploads: DataFrame) -> DataFrame:
    """(old, new, ord): every address of an asset (id, source_url, sizes) with that of its upload (source, url); each size is a crop of it.

    sizes is a map of name to (width, height, source_url). ord puts assets by id, each before its sizes, and these by name.
    """
    both = media.join(uploads.select(F.col("source").alias("id"), "url"), "id")
    crop = lambda s: F.concat("url", F.lit("?w="), s["width"].cast("string"), F.lit("&h="), s["height"].cast("string"), F.lit("&fit=crop"))
    place = lambda name: F.struct("id", name.alias("name")).alias("ord")
    thumbs = both.select("id", F.explode("sizes").alias("name", "size"), "url").select(F.col("size.source_url").alias("old"), crop(F.col("size")).alias("new"), place(F.col("name")))
    return both.select(F.col("source_url").alias("old"), F.col("url").alias("new"), place(F.lit(None).cast("string"))).unionByName(thumbs)
