"""Nested shop documents to product rows; what cannot be read is set aside."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelflens.config import SourceSpec
from shelflens.functions import variants as V
from shelflens.functions.numbers import clean_price_text, python_float


def _list_reason(doc: Column, products: Column, path: tuple[str, ...]) -> Column:
    """Why a document has no product list; NULL when it has one or lacks the key."""
    reason = F.when(doc.isNull(), F.lit("not json")).when(products.isNotNull(), F.lit(None))
    reason = reason.when(~V.is_object(doc), F.lit("not an object"))
    for depth in range(1, len(path)):
        step = "$." + ".".join(path[:depth])
        reason = reason.when(
            V.at(doc, step).isNotNull() & ~V.is_object(doc, step), F.lit(f"{step} is no object")
        )
    return reason.when(V.at(doc, "$." + ".".join(path)).isNotNull(), F.lit("not a list"))


def decode_products(
    documents: DataFrame, spec: SourceSpec, carry: tuple[str, ...] = ()
) -> DataFrame:
    """One row per list element and per rejected document.

    Columns ``file, pos, reason, product_name, sale_price``: ``reason`` is NULL for
    product rows; ``pos`` is NULL for whole-document rejects. Elements without a
    name are dropped, a price that is no number becomes NULL. The document's columns
    named in ``carry`` go along.
    """
    shop = "_shop"
    return decode_shops(documents.withColumn(shop, F.lit(spec.name)), (spec,), carry, shop).drop(shop)


def decode_shops(
    documents: DataFrame, specs: tuple[SourceSpec, ...], carry: tuple[str, ...] = (), shop: str = "shop"
) -> DataFrame:
    """``decode_products`` of documents of several shops, read and parsed once.

    Each document is read by the spec that its column ``shop`` names, which goes along; those of
    other shops drop out.
    """
    carry = (*carry, shop)

    def by_shop(rule: Callable[[SourceSpec], Column]) -> Column:
        """``rule`` for the spec of the row's shop."""
        if len(specs) == 1:
            return rule(specs[0])
        chain = F.when(F.col(shop) == specs[0].name, rule(specs[0]))
        for spec in specs[1:]:
            chain = chain.when(F.col(shop) == spec.name, rule(spec))
        return chain

    def list_path(spec: SourceSpec) -> str:
        return "$." + ".".join(spec.list_path)

    parsed = (
        documents.filter(F.col(shop).isin([s.name for s in specs]))
        .select("file", *carry, V.parse(F.col("value")).alias("doc"))
        .select("file", *carry, "doc", by_shop(lambda s: V.as_list(F.col("doc"), list_path(s))).alias("products"))
    )
    # The document ends here: carried on, it would be copied to each of its elements.
    judged = parsed.select(
        "file",
        *carry,
        "products",
        by_shop(lambda s: _list_reason(F.col("doc"), F.col("products"), s.list_path)).alias("doc_reason"),
    )
    # Every look into an element costs much more than what is done with its result. Filters move
    # below a projection and repeat what it computes, but never below the generator.
    width = max(len(s.name_paths) for s in specs), max(len(s.price_paths) for s in specs)

    def looked_up(spec: SourceSpec) -> Callable[[Column], Column]:
        def texts(product: Column, name: str, paths: tuple[str, ...], n: int) -> list[Column]:
            found = [V.as_text(product, p) for p in paths] + [F.lit(None).cast("string")] * (n - len(paths))
            return [text.alias(f"{name}{i}") for i, text in enumerate(found)]

        return lambda product: F.struct(
            product.alias("product"),
            *texts(product, "name", spec.name_paths, width[0]),
            *texts(product, "price", spec.price_paths, width[1]),
        )

    listed = judged.select(
        "file", *carry, "doc_reason", by_shop(lambda s: F.transform("products", looked_up(s))).alias("products")
    )
    elements = listed.select(
        "file", *carry, "doc_reason", F.posexplode_outer("products").alias("pos", "element")
    ).filter(F.col("pos").isNotNull() | F.col("doc_reason").isNotNull())

    product = F.col("element.product")

    def names(spec: SourceSpec) -> list[tuple[str, Column]]:
        return [(p, F.col(f"element.name{i}")) for i, p in enumerate(spec.name_paths)]

    def prices(spec: SourceSpec) -> list[tuple[str, Column]]:
        return [(p, F.col(f"element.price{i}")) for i, p in enumerate(spec.price_paths)]

    def chosen(found: list[tuple[str, Column]]) -> Column:
        """The text of the first truthy value; the last one's when none is truthy."""
        text = found[-1][1]
        for path, other in reversed(found[:-1]):
            text = F.when(V.is_truthy_text(other, product, path), other).otherwise(text)
        return text

    # What has something at a path is an object; the others are few.
    every = [f"element.{name}{i}" for name, n in zip(("name", "price"), width) for i in range(n)]
    found_any = reduce(or_, [F.col(text).isNotNull() for text in every])
    reason = F.when(F.col("pos").isNull(), F.col("doc_reason")).when(
        ~found_any & ~V.is_object(product), F.lit("product is no object")
    )
    is_named = by_shop(lambda s: reduce(or_, [V.is_truthy_text(text, product, path) for path, text in names(s)]))
    named = elements.withColumn("reason", reason).filter(F.col("reason").isNotNull() | is_named)
    texts = named.select(
        "file", *carry, "pos", "reason",
        by_shop(lambda s: chosen(names(s))).alias("product_name"),
        by_shop(lambda s: chosen(prices(s))).alias("price"),
    ).withColumn("price_text", clean_price_text(F.col("price")))
    return texts.select(
        "file", *carry, "pos", "reason", "product_name",
        python_float(F.col("price_text")).alias("sale_price"),
    )


def flatten(documents: DataFrame, spec: SourceSpec) -> DataFrame:
    """Product rows ``(product_name, sale_price)`` of all documents."""
    return decode_products(documents, spec).filter(F.col("reason").isNull()).select(
        "product_name", "sale_price"
    )


def quarantine(documents: DataFrame, spec: SourceSpec) -> DataFrame:
    """Rejected documents and elements ``(file, pos, reason)``."""
    return decode_products(documents, spec).filter(F.col("reason").isNotNull()).select(
        "file", "pos", "reason"
    )
