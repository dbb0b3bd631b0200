"""The family graph: kinship, callsets, trios, generations, consent."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vardelta.operators import ancestry


def callset_to_person(callsets: DataFrame, people: DataFrame) -> DataFrame:
    """(sample_id, person): the id itself if it is a person, else its longest ``_`` prefix that is, else itself."""
    parts = F.split("sample_id", "_")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "_"))
    rows = callsets.select("sample_id").distinct().select("sample_id", F.explode(prefixes).alias("prefix"))
    named = rows.join(people.select(F.col("id").alias("prefix"), F.lit(True).alias("known")), "prefix", "left")
    best = F.max_by(F.when(F.col("known"), F.col("prefix")), F.when(F.col("known"), F.length("prefix")))
    return named.groupBy("sample_id").agg(F.coalesce(best, F.col("sample_id")).alias("person"))


def parent_edges(people: DataFrame) -> DataFrame:
    """(child, parent) of parents who are persons of the graph."""
    ids = people.select(F.col("id").alias("parent"))
    pairs = people.select(F.col("id").alias("child"), F.explode(F.array("father", "mother")).alias("parent"))
    return pairs.join(ids, "parent", "left_semi").select("child", "parent")


def partners(people: DataFrame) -> DataFrame:
    """(a, b): the partner of each person, as either of the two states it."""
    told = people.where("partner is not null").select(F.col("id").alias("a"), F.col("partner").alias("b"), F.lit(0).alias("w"))
    back = told.select(F.col("b").alias("a"), F.col("a").alias("b"), F.lit(1).alias("w"))
    return told.union(back).groupBy("a").agg(F.min_by("b", F.struct("w", "b")).alias("b"))


def kinship(people: DataFrame) -> DataFrame:
    """(ego, other, term) of every ordered pair: the first relation of a fixed order that holds.

    Pairs are those of one ``family``, a column of ``people``: pairs of strangers are never made. Each relation is a
    join of edges; their union keeps the least rank of a pair.
    """
    up = parent_edges(people)
    parent = up.select(F.col("child").alias("x"), F.col("parent").alias("y"))
    child = up.select(F.col("parent").alias("x"), F.col("child").alias("y"))
    mate = partners(people).select(F.col("a").alias("x"), F.col("b").alias("y"))

    def then(first: DataFrame, second: DataFrame) -> DataFrame:
        via = first.withColumnRenamed("y", "m").join(second.withColumnRenamed("x", "m"), "m")
        return via.select("x", "y").distinct()

    sibling = then(parent, child).where("x <> y")
    uncle = then(parent, sibling)
    relations = [
        ("self", "self", "self", people.select(F.col("id").alias("x"), F.col("id").alias("y"))),
        ("father", "mother", "parent", parent), ("son", "daughter", "child", child), ("partner",) * 3 + (mate,),
        ("brother", "sister", "sibling", sibling),
        ("grandfather", "grandmother", "grandparent", then(parent, parent)),
        ("grandson", "granddaughter", "grandchild", then(child, child)),
        ("father-in-law", "mother-in-law", "parent-in-law", then(mate, parent)),
        ("brother-in-law", "sister-in-law", "sibling-in-law", then(mate, sibling)),
        ("son-in-law", "daughter-in-law", "child-in-law", then(child, mate)),
        ("brother-in-law", "sister-in-law", "sibling-in-law", then(sibling, mate)),
        ("uncle", "aunt", "relative", uncle), ("nephew", "niece", "relative", then(sibling, child)),
        ("cousin",) * 3 + (then(uncle, child),),
    ]
    ranked = [
        r.select("x", "y", F.lit(i).alias("rank"), F.lit(m).alias("m"), F.lit(f).alias("f"), F.lit(n).alias("n"))
        for i, (m, f, n, r) in enumerate(relations)
    ]
    best = reduce(DataFrame.union, ranked).groupBy("x", "y").agg(F.min(F.struct("rank", "m", "f", "n")).alias("r"))
    every = people.select("family", F.col("id").alias("x")).join(people.select("family", F.col("id").alias("y"), "sex"), "family")
    found = every.join(best, ["x", "y"], "left")
    term = F.when(F.col("sex") == "male", F.col("r.m")).when(F.col("sex") == "female", F.col("r.f")).otherwise(F.col("r.n"))
    return found.select(F.col("x").alias("ego"), F.col("y").alias("other"), F.coalesce(term, F.lit("relative")).alias("term"))


def trio(people: DataFrame, callset_person: DataFrame) -> DataFrame:
    """Children with both parents known, and whether all three were sequenced."""
    ids = people.select("id")
    rows = people.select(F.col("id").alias("child"), "father", "mother")
    for side in ("father", "mother"):
        rows = rows.join(ids.withColumnRenamed("id", side), side, "left_semi")
    seen = callset_person.select("person").distinct()
    for side in ("child", "father", "mother"):
        flag = seen.select(F.col("person").alias(side), F.lit(1).alias(f"{side}_seen"))
        rows = rows.join(flag, side, "left")
    total = F.col("child_seen").isNotNull() & F.col("father_seen").isNotNull() & F.col("mother_seen").isNotNull()
    return rows.select("child", "father", "mother", total.alias("sequenced"))


def generations(people: DataFrame) -> DataFrame:
    """(id, generation): 1 + the greatest of the parents'; founders 0, or their partner's if that is later.

    Null for persons on or below a cycle of ancestors, who have none.
    """
    up, mates = parent_edges(people), partners(people)
    rows = people.select("id").distinct().join(ancestry.levels(people, up), "id", "left").withColumnRenamed("level", "generation")
    mate = rows.select(F.col("id").alias("b"), F.col("generation").alias("mate_generation"))
    founder = up.select(F.col("child").alias("id"), F.lit(True).alias("has_parents")).distinct()
    joined = rows.join(mates.withColumnRenamed("a", "id"), "id", "left").join(mate, "b", "left").join(founder, "id", "left")
    own = F.when(F.col("has_parents"), F.col("generation")).otherwise(
        F.greatest("generation", F.coalesce("mate_generation", F.lit(0)))
    )
    return joined.select("id", own.alias("generation"))


def pedigree_issues(people: DataFrame) -> DataFrame:
    """Dangling references, parents of the wrong sex, callsets entered as persons, persons who are their own ancestors.

    A callset is a person whose id goes on, after an underscore, from another person's; the longest such person is named.
    """
    ids = people.select(F.col("id").alias("named"), F.col("sex").alias("named_sex"), F.lit(True).alias("known"))
    named = people.select("id", F.explode(F.array(*[
        F.struct(F.lit(c).alias("role"), F.col(c).alias("named")) for c in ("father", "mother", "partner")
    ])).alias("r")).select("id", "r.*").where("named is not null")
    joined = named.join(ids, "named", "left")
    dangling = joined.where("known is null").select("id", F.concat("role", F.lit(" unknown: "), "named").alias("issue"))
    wrong = joined.where("(role = 'father' and named_sex = 'female') or (role = 'mother' and named_sex = 'male')")
    wrong = wrong.select("id", F.concat("role", F.lit(" has the other sex: "), "named").alias("issue"))
    parts = F.split("id", "_")
    shorter = F.transform(
        F.when(F.size(parts) > 1, F.sequence(F.lit(1), F.size(parts) - 1)).otherwise(F.array().cast("array<int>")),
        lambda n: F.array_join(F.slice(parts, F.lit(1), n), "_"),
    )
    owners = people.select("id", F.explode(shorter).alias("named")).join(ids, "named")
    owner = owners.groupBy("id").agg(F.max_by("named", F.length("named")).alias("named"))
    callset = owner.select("id", F.concat(F.lit("callset of "), "named").alias("issue"))
    cycles = ancestry.on_cycles(parent_edges(people)).select("id", F.lit("is its own ancestor").alias("issue"))
    return dangling.union(wrong).union(callset).union(cycles)


def pedigree_export(people: DataFrame, callset_person: DataFrame) -> DataFrame:
    """A row per callset: its parents' callsets of the same suffix where there are any, else the persons."""
    rows = callset_person.join(people.withColumnRenamed("id", "person"), "person")
    suffix = F.expr("substring(sample_id, length(person) + 1)")
    rows = rows.withColumn("suffix", suffix)
    have = callset_person.select(F.col("sample_id").alias("have"))
    for side in ("father", "mother"):
        wanted = rows.withColumn("have", F.concat(side, "suffix"))
        rows = wanted.join(have.withColumn(f"{side}_has", F.lit(True)), "have", "left")
        rows = rows.withColumn(side, F.when(F.col(f"{side}_has"), F.col("have")).otherwise(F.coalesce(side, F.lit("0")))).drop("have")
    code = F.when(F.col("sex") == "male", 1).when(F.col("sex") == "female", 2).otherwise(0)
    return rows.select("sample_id", "person", "father", "mother", code.alias("sex_code"))


def resolved_consent(consent: DataFrame, callset_person: DataFrame) -> DataFrame:
    """(person, category, granted): a person's own row beats one of a callset; of equals a refusal wins."""
    rows = consent.join(callset_person, "sample_id", "left").withColumn("person", F.coalesce("person", "sample_id"))
    yes = F.lower("consent") == "yes"
    own = F.col("sample_id") == F.col("person")
    return rows.groupBy("person", "category").agg(F.min_by(yes, F.struct((~own).alias("o"), yes.alias("y"))).alias("granted"))


def consent_gate(rows: DataFrame, resolved: DataFrame, category: str) -> DataFrame:
    """Rows of persons who agreed to the category; without a word there is no consent."""
    ok = resolved.where((F.col("category") == category) & F.col("granted")).select("person")
    return rows.join(ok, "person", "left_semi")


def fold_consent(ledger: DataFrame, change: DataFrame, callset_person: DataFrame) -> DataFrame:
    """The ledger with ``change`` applied: one row a (person, category), callset rows folded into the person's."""
    before = resolved_consent(ledger, callset_person).withColumn("age", F.lit(1))
    after = resolved_consent(change, callset_person).withColumn("age", F.lit(0))
    newest = before.union(after).groupBy("person", "category").agg(F.min_by("granted", "age").alias("granted"))
    return newest.select("person", "category", F.when(F.col("granted"), "yes").otherwise("no").alias("consent"))


def fully_consented(variants: DataFrame, carriers: DataFrame, resolved: DataFrame, category: str, key: list[str]) -> DataFrame:
    """Variants all of whose carriers agreed; a variant without carriers goes. ``carriers``: key, person."""
    granted = resolved.where(F.col("category") == category).select("person", "granted")
    every = carriers.join(granted, "person", "left").groupBy(*key).agg(
        F.bool_and(F.coalesce("granted", F.lit(False))).alias("all_granted")
    )
    return variants.join(every.where("all_granted"), key, "left_semi")
