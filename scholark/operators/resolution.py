"""Entity resolution: surface forms, strategies in order, fuzzy and prefix joins, metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import surface_form

FUZZY_CAP, FUZZY_LEAST = 2, 4


def fuzzy_confidence(distance: Column, a: Column, b: Column) -> Column:
    return 1 - distance / F.greatest(F.length(a), F.length(b)) * 0.5


def fuzzy_join(forms: DataFrame, reference: DataFrame, form: str, name: str, kind: str) -> DataFrame:
    """Pairs of the same kind within two edits, by a length band as an equi-join (no cross join).

    ``reference`` is replicated over the five lengths it can match; both sides are distinct forms.
    """
    left = forms.select(kind, F.col(form).alias("form")).where(F.length("form") >= FUZZY_LEAST).distinct().withColumn("size", F.length("form"))
    band = F.explode(F.sequence(F.length("name") - FUZZY_CAP, F.length("name") + FUZZY_CAP)).alias("size")
    right = reference.select(kind, F.col(name).alias("name")).where(F.length("name") >= FUZZY_LEAST).distinct().select(kind, "name", band)
    pairs = left.join(right, [kind, "size"]).withColumn("distance", F.levenshtein("form", "name", FUZZY_CAP)).where("distance >= 0")
    return pairs.select(kind, "form", "name", "distance", F.round(fuzzy_confidence(F.col("distance"), F.col("form"), F.col("name")), 6).alias("confidence"))


def prefix_lookup(forms: DataFrame, prefix: str, cap: int = 50) -> DataFrame:
    return forms.where(F.col("form").startswith(prefix)).select("form").distinct().orderBy("form").limit(cap)


def genus_initial(form: Column) -> Column:
    """``X. species`` -> struct(initial, species), null otherwise."""
    f = F.lower(F.trim(form))
    return F.when(f.rlike(r"^[a-z]\. ?[a-z]{3,}$"), F.struct(F.substring(f, 1, 1).alias("initial"), F.regexp_extract(f, r"([a-z]{3,})$", 1).alias("species")))


def expand_abbreviations(forms: DataFrame, abbreviations: DataFrame) -> DataFrame:
    """Every expansion of a form, each with confidence 1/N."""
    got = forms.join(F.broadcast(abbreviations), F.lower("form") == F.lower("abbreviated_form"))
    n = F.count("*").over(Window.partitionBy("form"))
    return got.select("form", "full_form", F.round(1.0 / n, 6).alias("confidence"))


def expand_genus(forms: DataFrame, taxa: DataFrame) -> DataFrame:
    """Taxa whose genus begins with the initial and whose species is the same; each with confidence 1/N."""
    left = forms.select("form", genus_initial(F.col("form")).alias("g")).where("g is not null").select("form", "g.initial", "g.species").distinct()
    right = taxa.select("canonical_id", F.lower(F.substring("primary_name", 1, 1)).alias("initial"), F.lower(F.element_at(F.split("primary_name", " "), -1)).alias("species"))
    got = left.join(right, ["initial", "species"])
    return got.select("form", "canonical_id", F.round(1.0 / F.count("*").over(Window.partitionBy("form")), 6).alias("confidence"))


def synonym_conflicts(synonyms: DataFrame) -> DataFrame:
    """Normalised forms that stand for more than one entity."""
    rows = synonyms.where("canonical_id is not null").select(surface_form(F.col("surface_form")).alias("form"), "canonical_id").where("form <> ''")
    return rows.groupBy("form").agg(F.count_distinct("canonical_id").alias("n_entities"), F.count("*").alias("n_rows")).where("n_entities > 1")


# The strategies in order, with the confidence of those that have one of their own.
STRATEGIES = ("manual_override", "exact", "abbreviation", "synonym", "fuzzy", "ontology")
SYNONYM, LEAST = 0.95, 0.5


def candidates(forms: DataFrame, entities: DataFrame, synonyms: DataFrame, abbreviations: DataFrame, overrides: DataFrame | None = None, hierarchy: DataFrame | None = None) -> DataFrame:
    """(form, entity_type, canonical_id, strategy, confidence): what every strategy finds for each distinct form.

    Overrides (of the same type), names, expansions of abbreviations and of genus initials (each 1/N; the table's first),
    synonyms, names of the same type within two edits, and known ancestors (``hierarchy`` of child and parent ids, for forms
    that name a child).  Of one strategy and form, every entity is a candidate.
    """
    left = forms.select("form", "entity_type").where("form is not null").distinct().withColumn("norm", surface_form(F.col("form"))).where("norm <> ''")
    names = entities.select("canonical_id", F.col("entity_type").alias("kind"), "primary_name", surface_form(F.col("primary_name")).alias("norm"))
    keys = left.select("form", "entity_type", "norm")

    def rows(df: DataFrame, strategy: str, confidence: Column) -> DataFrame:
        return df.select("form", "entity_type", "canonical_id", F.lit(strategy).alias("strategy"), confidence.cast("double").alias("confidence")).distinct()

    found = [rows(keys.join(names, "norm"), "exact", F.lit(1.0))]
    if overrides is not None:
        said = overrides.select(surface_form(F.col("surface_form")).alias("norm"), "entity_type", "canonical_id")
        found.append(rows(keys.join(said, ["norm", "entity_type"]), "manual_override", F.lit(1.0)))
    short = abbreviations.select(surface_form(F.col("abbreviated_form")).alias("norm"), "full_form").distinct()
    spelled = keys.join(short, "norm").select("form", "entity_type", F.col("full_form").alias("full"))
    # initials stand for a genus only where the table has no expansion
    rest = keys.join(spelled.select("form", "entity_type").distinct(), ["form", "entity_type"], "left_anti").withColumn("g", genus_initial(F.col("form"))).where("g is not null")
    taxa = names.where("kind = 'taxon'").select(F.lower(F.substring("primary_name", 1, 1)).alias("initial"), F.lower(F.element_at(F.split("primary_name", " "), -1)).alias("species"), F.col("primary_name").alias("full"))
    spelled = spelled.unionByName(rest.select("form", "entity_type", "g.initial", "g.species").join(taxa, ["initial", "species"]).select("form", "entity_type", "full")).distinct()
    n = spelled.groupBy("form", "entity_type").agg(F.count("*").alias("n"))
    expanded = spelled.join(n, ["form", "entity_type"]).withColumn("norm", surface_form(F.col("full"))).join(names.select("norm", "canonical_id"), "norm")
    found.append(rows(expanded, "abbreviation", 1.0 / F.col("n")))
    spoken = synonyms.where("canonical_id is not null").select(surface_form(F.col("surface_form")).alias("norm"), "canonical_id").distinct()
    found.append(rows(keys.join(spoken, "norm"), "synonym", F.lit(SYNONYM)))
    near = fuzzy_join(keys.select("entity_type", "norm"), names.select(F.col("kind").alias("entity_type"), "norm"), "norm", "norm", "entity_type").where("distance > 0")
    near = near.select("entity_type", F.col("form").alias("norm"), F.col("name"), F.col("confidence").alias("c"))
    fuzzy = keys.join(near, ["entity_type", "norm"]).join(names.select(F.col("norm").alias("name"), F.col("kind").alias("entity_type"), "canonical_id"), ["name", "entity_type"])
    found.append(rows(fuzzy, "fuzzy", F.col("c")))
    if hierarchy is not None:
        up = ancestors(hierarchy, "child", "parent").select(F.col("node").alias("canonical_id"), "ancestor", F.col("confidence").alias("c"))
        known = keys.join(names, "norm").join(up, "canonical_id").select("form", "entity_type", F.col("ancestor").alias("canonical_id"), "c")
        found.append(rows(known, "ontology", F.col("c")))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def resolve(forms: DataFrame, entities: DataFrame, synonyms: DataFrame, abbreviations: DataFrame, overrides: DataFrame | None = None, hierarchy: DataFrame | None = None) -> DataFrame:
    """(form, entity_type, canonical_id, strategy, confidence) of distinct forms: the first strategy that reaches .5 wins.

    Within a strategy the highest confidence wins, then the smallest id; of an abbreviation's expansions the same.  Later
    strategies count for nothing where an earlier one wins; forms that no strategy reaches are ``unresolved``.
    """
    order = F.lit(len(STRATEGIES))
    for k, name in reversed(list(enumerate(STRATEGIES))):
        order = F.when(F.col("strategy") == name, k).otherwise(order)
    got = candidates(forms, entities, synonyms, abbreviations, overrides, hierarchy).where(F.col("confidence") >= LEAST)
    best = got.groupBy("form", "entity_type").agg(F.min(F.struct(order.alias("o"), (-F.col("confidence")).alias("c"), "canonical_id", "strategy")).alias("b"))
    every = forms.select("form", "entity_type").where("form is not null").distinct().where(surface_form(F.col("form")) != "")
    out = every.join(best, ["form", "entity_type"], "left")
    return out.select("form", "entity_type", F.col("b.canonical_id").alias("canonical_id"), F.coalesce("b.strategy", F.lit("unresolved")).alias("strategy"), F.coalesce(-F.col("b.c"), F.lit(0.0)).alias("confidence"))


def resolution_metrics(resolved: DataFrame) -> DataFrame:
    """Rate, mean confidence of the resolved and unresolved numbers per strategy, per entity type and over all (both null)."""
    known = F.col("canonical_id").isNotNull()
    measures = [
        F.count("*").alias("n_total"), F.count_if(known).alias("n_resolved"), F.count_if(~known).alias("n_unresolved"),
        F.round(F.avg(F.when(known, F.col("confidence"))), 6).alias("avg_confidence"), F.round(F.avg(known.cast("int")), 6).alias("resolution_rate"),
    ]
    return resolved.groupingSets([["strategy"], ["entity_type"], []], "strategy", "entity_type").agg(*measures)


def degradation(snapshots: DataFrame, kind: str, at: str, rate: str, points: float = 0.05) -> DataFrame:
    """Latest snapshot per kind against the mean of the earlier ones; degraded when it fell by more than ``points``."""
    w = Window.partitionBy(kind).orderBy(at)
    rows = snapshots.withColumns({"prior": F.avg(rate).over(w.rowsBetween(Window.unboundedPreceding, -1)), "next": F.lead(at).over(w)})
    rows = rows.where(F.col("next").isNull() & F.col("prior").isNotNull())
    return rows.select(kind, at, F.round(rate, 6).alias("rate"), F.round("prior", 6).alias("prior"), (F.round(F.col("prior") - F.col(rate), 9) > points).alias("degraded"))


def ancestors(edges: DataFrame, child: str, parent: str, levels: int = 3) -> DataFrame:
    """(node, ancestor, level, confidence): up to ``levels`` steps, unrolled self joins; .5 less .1 a level."""
    e = edges.select(F.col(child).alias("c"), F.col(parent).alias("p")).distinct()
    level = e.select(F.col("c").alias("node"), F.col("p").alias("ancestor"))
    out = level.withColumn("level", F.lit(1))
    for n in range(2, levels + 1):
        level = level.join(e, level["ancestor"] == e["c"]).select("node", F.col("p").alias("ancestor")).distinct()
        out = out.unionByName(level.withColumn("level", F.lit(n)))
    return out.withColumn("confidence", F.round(0.5 - 0.1 * (F.col("level") - 1), 6))


def nearest_registered(up: DataFrame, registered: DataFrame, key: str) -> DataFrame:
    """(node, ancestor, level): the nearest ancestor that the registry has, the smallest id on ties; ``up`` of ``ancestors``."""
    known = registered.select(F.col(key).alias("ancestor")).distinct()
    got = up.join(known, "ancestor").groupBy("node").agg(F.min(F.struct("level", "ancestor")).alias("b"))
    return got.select("node", F.col("b.ancestor").alias("ancestor"), F.col("b.level").alias("level"))
