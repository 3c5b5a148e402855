"""A table of (subject, predicate, object) facts and the operators on it.

Columns: ``s``, ``p``, ``o`` (text), ``dtype`` (datatype IRI of a literal, NULL
for links and plain text) and ``is_iri`` (``o`` names a node).  A graph is a
set: ``union_graphs`` removes duplicates.  ``dtype`` of a text with a language is ``@`` and its tag.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from altimart.fixed_values import RDF_TYPE, RDFS, XSD
from altimart.operators import closure

col, lit = F.col, F.lit
COLUMNS = ("s", "p", "o", "dtype", "is_iri")


def union_graphs(*graphs: DataFrame) -> DataFrame:
    """Set union, dealt by subject: grouping the result by subject needs no further shuffle."""
    return reduce(DataFrame.unionByName, graphs).repartition("s").distinct()


def local_name(iri: Column) -> Column:
    return F.substring_index(iri, "#", -1)


def lexical(value: Column, kind: str) -> Column:
    """Text of a literal.  Decimals in plain notation with at least one decimal place."""
    if kind == "decimal":
        plain = value.cast("decimal(38,6)").cast("string")
        return F.regexp_replace(plain, r"(\.\d+?)0+$", "$1")
    if kind == "integer":
        return value.cast("long").cast("string")
    return value.cast("string")


def typed(text: Column, kind: str) -> Column:
    """A literal's text back as a value; NULL where it is not one."""
    to = {"decimal": "double", "integer": "long", "boolean": "boolean"}.get(kind)
    return text.try_cast(to) if to else text


def _fact(p: str, o: Column, dtype: str | None, is_iri: bool) -> Column:
    return F.struct(
        lit(p).alias("p"),
        o.alias("o"),
        lit(dtype).cast("string").alias("dtype"),
        lit(is_iri).alias("is_iri"),
    )


def row_facts(
    df: DataFrame,
    subject: Column,
    rdf_type: str,
    literals: Mapping[str, tuple[str, Column]],
    links: Mapping[str, Column] = {},
) -> DataFrame:
    """Wide rows to triples in one narrow pass: a type, literals and links per row.

    NULL values give no triple and neither do rows without a subject.
    """
    facts = [_fact(RDF_TYPE, lit(rdf_type), None, True)]
    facts += [
        _fact(p, lexical(value, kind), XSD + kind, False) for p, (kind, value) in literals.items()
    ]
    facts += [_fact(p, target, None, True) for p, target in links.items()]
    exploded = df.select(subject.alias("s"), F.inline(F.array(*facts)))
    return exploded.where(col("s").isNotNull() & col("o").isNotNull()).select(*COLUMNS)


def node_types(nodes: DataFrame, name: str, rdf_type: str) -> DataFrame:
    """A type triple for every distinct node in a column."""
    return (
        nodes.select(col(name).alias("s"))
        .where(col("s").isNotNull())
        .distinct()
        .select("s", lit(RDF_TYPE).alias("p"), lit(rdf_type).alias("o"),
                lit(None).cast("string").alias("dtype"), lit(True).alias("is_iri"))
    )


def star(
    graph: DataFrame,
    rdf_type: str,
    properties: Mapping[str, tuple[str, str]],
    marks: Mapping[str, str] = {},
    types_in: str | None = None,
) -> DataFrame:
    """One row per subject of a type, with properties as columns.

    ``properties`` maps a column to (predicate, kind), ``marks`` a boolean column
    to a class: is the subject of that class too?  A subject with several values
    of one property shows the greatest text.  Missing properties are NULL.
    ``types_in`` adds ``types``, every class of that namespace a subject has.
    """
    classes = [rdf_type, *marks.values()]
    typing = col("p") == RDF_TYPE
    of_namespace = typing & F.startswith(col("o"), lit(types_in or ""))
    kinds = of_namespace if types_in else typing & col("o").isin(*classes)
    wanted = graph.where(col("p").isin(*[p for p, _ in properties.values()]) | kinds)
    types = [F.collect_set(F.when(of_namespace, col("o"))).alias("types")] if types_in else []

    def is_a(name: str) -> Column:
        return F.coalesce(F.bool_or((col("p") == RDF_TYPE) & (col("o") == name)), lit(False))

    rows = wanted.groupBy("s").agg(
        is_a(rdf_type).alias("__is_a"),
        *[F.max(F.when(col("p") == p, col("o"))).alias(name) for name, (p, _) in properties.items()],
        *[is_a(iri).alias(name) for name, iri in marks.items()],
        *types,
    )
    return rows.where("__is_a").select(
        "s",
        *[typed(col(name), kind).alias(name) for name, (_, kind) in properties.items()],
        *marks,
        *(["types"] if types_in else []),
    )


def disjoint_violations(graph: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Subjects that are members of two classes declared disjoint.

    One pass reduces every subject to one boolean per class of the pairs; no
    self-join of memberships is needed.
    """
    classes = sorted({c for pair in pairs for c in pair})
    members = graph.where((col("p") == RDF_TYPE) & col("o").isin(*classes))
    per_subject = members.groupBy("s").agg(
        *[F.bool_or(col("o") == c).alias(f"__{i}") for i, c in enumerate(classes)]
    )
    found = F.array_compact(
        F.array(
            *[
                F.when(
                    col(f"__{classes.index(a)}") & col(f"__{classes.index(b)}"),
                    F.struct(lit(a).alias("class_1"), lit(b).alias("class_2")),
                )
                for a, b in pairs
            ]
        )
    )
    return per_subject.select("s", F.inline(found))


def same_as(graph: DataFrame, mapping: DataFrame) -> DataFrame:
    """The graph plus, for every (local, external) pair, the external node's facts on the local one."""
    borrowed = graph.join(mapping.select(col("external").alias("s"), "local"), "s").select(
        col("local").alias("s"), *COLUMNS[1:]
    )
    return union_graphs(graph.select(*COLUMNS), borrowed)


def same_as_closure(graph: DataFrame, links: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The graph with every fact on one node of a class of equal nodes on all of them.

    ``links`` are pairs (local, external) that name one thing; they may form chains and cycles, and any
    side may have the facts.  Facts of a class are brought together once, under its smallest node, and
    dealt out from there.  Use ``canonical`` for classes too large to repeat their facts in.
    """
    classes = closure.classes(links.select(col("local").alias("a"), col("external").alias("b")), keep)
    gathered = _on_label(graph, classes)
    dealt = gathered.join(classes, "label").select(col("node").alias("s"), *COLUMNS[1:])
    return union_graphs(graph.select(*COLUMNS), dealt)


def canonical(graph: DataFrame, links: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The graph with each node of a class of equal nodes replaced by the smallest, as subject and as
    target of links; nothing is repeated."""
    classes = closure.classes(links.select(col("local").alias("a"), col("external").alias("b")), keep)
    subject = classes.withColumnsRenamed({"node": "s", "label": "__s"})
    target = classes.withColumnsRenamed({"node": "o", "label": "__o"}).withColumn("is_iri", lit(True))
    named = graph.join(subject, "s", "left").join(target, ["o", "is_iri"], "left")
    return union_graphs(
        named.select(F.coalesce("__s", "s").alias("s"), "p", F.coalesce("__o", "o").alias("o"), "dtype", "is_iri")
    )


def _on_label(graph: DataFrame, classes: DataFrame) -> DataFrame:
    # dealt by label: the facts of a class are told apart, and met by its nodes, where they are
    found = graph.join(classes.withColumnRenamed("node", "s"), "s").select("label", *COLUMNS[1:])
    return found.repartition("label").distinct()


def entailed(graph: DataFrame, schema: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The graph with the memberships that a schema implies.

    A subject with a property is in the property's domain, the target of a link in its range, and a
    member of a class is one of every class above it, however many levels.  ``schema`` is a graph with
    ``subClassOf``, ``domain`` and ``range``; what is above each of its classes is found first, by a
    semi-naive fixpoint over the few schema rows, so the facts are joined with it once.
    """
    def of(p: str) -> DataFrame:
        return schema.where(col("p") == RDFS + p).select(col("s").alias("a"), col("o").alias("b"))

    sub = of("subClassOf")
    above = closure.reached(sub, sub, keep)
    links = graph.where(col("p") != RDF_TYPE)
    by_subject = links.join(of("domain").withColumnsRenamed({"a": "p", "b": "kind"}), "p").select("s", "kind")
    by_target = links.where("is_iri").join(of("range").withColumnsRenamed({"a": "p", "b": "kind"}), "p").select(col("o").alias("s"), "kind")
    direct = graph.where(col("p") == RDF_TYPE).select("s", col("o").alias("kind")).unionByName(by_subject).unionByName(by_target).distinct()
    higher = direct.join(above.withColumnsRenamed({"a": "kind", "b": "base"}), "kind").select("s", col("base").alias("kind"))
    members = direct.unionByName(higher).select(
        "s", lit(RDF_TYPE).alias("p"), col("kind").alias("o"), lit(None).cast("string").alias("dtype"), lit(True).alias("is_iri")
    )
    return union_graphs(graph.select(*COLUMNS), members)
