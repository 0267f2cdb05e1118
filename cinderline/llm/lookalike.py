"""Documents that look the same but differ in their characters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .canonical import skeleton_text


def look_classes(documents: DataFrame, *, key: str, text: str) -> DataFrame:
    """(key, look, form): look is the digest of the text with plain letters (skeleton), form that of the text as it stands.

    One row per document whose text has a visible character; null, empty and blank texts are left out. Texts look the
    same where look is equal and are equal where form is too. The key column keeps its name.
    """
    rows = documents.select(F.col(key), F.col(text).alias("__t")).where(F.col("__t").isNotNull())
    rows = rows.select(key, "__t", skeleton_text(F.col("__t")).alias("__c")).where(F.col("__c").rlike(r"[^\s]"))
    return rows.select(key, F.md5("__c").alias("look"), F.md5("__t").alias("form"))


def lookalike_pairs(documents: DataFrame, *, key: str, text: str) -> DataFrame:
    """(key_a, key_b), smaller first: every two documents that look the same and are not equal character by character.

    Documents with a null key cannot be named and make no pair; documents that share a key make none with each other.

    Forms, not documents, are paired within a look: exact copies, however many, are one form with its members, so a class
    of equal texts alone makes no pair, and the members are joined in only for forms that have a partner. Adaptive
    execution splits a form with very many members, as its rows on the other side are one per partner form.
    """
    classes = cut_lineage(look_classes(documents.where(F.col(key).isNotNull()), key=key, text=text))
    forms = classes.select("look", "form").distinct()
    several = forms.groupBy("look").agg(F.count("*").alias("k")).where("k > 1").select("look")
    members = cut_lineage(classes.join(several, "look", "left_semi"))  # looks of one form alone, that is most, go no further
    forms = members.select("look", "form").distinct()
    partners = forms.select("look", F.col("form").alias("form_a")).join(forms.select("look", F.col("form").alias("form_b")), "look").where("form_a < form_b")
    a = members.select("look", F.col("form").alias("form_a"), F.col(key).alias("__a"))
    b = members.select("look", F.col("form").alias("form_b"), F.col(key).alias("__b"))
    pairs = partners.join(a, ["look", "form_a"]).join(b, ["look", "form_b"])
    return pairs.select(F.least("__a", "__b").alias(f"{key}_a"), F.greatest("__a", "__b").alias(f"{key}_b")).where(f"{key}_a <> {key}_b").distinct()
