"""Catalogued clusters with sequence context, lineage-specific motifs and a graded evidence level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terminus.functions.sequence import context_bounds, display, first_motif, fraction, reverse_complement, rich_hexamer, window
from terminus.sources.tables import fetch

# Motif lists of the lineage models, in order of priority.
CANONICAL = ["AATAAA", "ATTAAA"]
VARIANT = ["AGTAAA", "TATAAA", "CATAAA", "GATAAA", "AATATA", "AATACA", "AATAGA", "ACTAAA", "AAGAAA", "AATGAA", "TTTAAA"]
UPSTREAM = ["TGTA", "TATA", "ATAT", "TTTT"]
DOWNSTREAM = ["TGTG", "GTGT", "TTTT", "GGGG"]
PLANT_NEAR = ["AATAAA", "ATTAAA", "AGTAAA", "TATAAA", "AATGAA"]
PLANT_FAR = ["TTTGTA", "TTGTAT", "TTGTAA", "TTGTA", "TTGTT", "TGTGTA"]
EFFICIENCY = ["TATATA", "TATGTA", "TACATA", "TAAATA", "TATTTA", "ATATAT"]
POSITIONING = ["AATAAA", "AAAAAAAA", "TTAAGAAC", "AAGAA", "AATAATGA"]
A_RICH = ["AATAAA", "TTAATA", "TAATAT", "ATTAAT"]
UAG = ["ATAGTT", "ATTAGT", "ATTTAG", "GTTTAG", "TAGATA", "TAGATT", "TAGGTT", "TAGTTA", "TAGTTT", "TATAGA", "TATAGT", "TATTAG", "TTAGAT", "TTAGGT", "TTAGTT", "TTATAG", "TTTAGA", "TTTAGT", "TTTTAG"]
GUA = ["AAAGTA", "AAGTAA", "AATGTA", "AGTAAA", "ATGTAA", "ATGTAT", "ATTGTA", "GTAAAA", "GTAAAG", "GTAAAT", "GTAATT", "GTATAT", "GTATTT", "TAAGTA", "TATGTA", "TGTAAA", "TGTAAG", "TGTAAT", "TGTATA", "TGTATT", "TTGTAA", "TTGTAT", "TTTGTA"]
GUA_UAG = ["AAGTAG", "AGTAGT", "GTAGTA", "GTAGTT", "TAGTAA", "TAGTAG", "TAGTAT", "TGTAGA", "TGTAGT", "TTAGTA", "TTGTAG"]

# Per model its steps as (window, motifs or None for rich hexamers, motif type, search level, support).
STEPS = {
    "MAMMALIAN": [
        (-40, 0, CANONICAL, "canonical", "mammalian_hexamer", "primary"),
        (-40, 0, VARIANT, "variant", "mammalian_hexamer", "primary"),
        (-40, 0, UPSTREAM, "upstream", "mammalian_upstream", "auxiliary"),
        (1, 41, DOWNSTREAM, "downstream", "mammalian_downstream", "auxiliary"),
    ],
    "LAND_PLANT": [
        (-30, -9, PLANT_NEAR, "plant_nue", "plant_nue", "primary"),
        (-150, -29, PLANT_FAR, "plant_fue", "plant_fue", "auxiliary"),
    ],
    "BUDDING_YEAST": [
        (-30, -9, POSITIONING, "yeast_positioning", "yeast_pe", "auxiliary"),
        (-60, -34, EFFICIENCY, "yeast_efficiency", "yeast_ee", "auxiliary"),
        (-10, 11, None, "yeast_u_rich", "yeast_u_rich", "auxiliary"),
    ],
    "FISSION_YEAST": [
        (-30, -9, A_RICH, "pombe_a_rich", "pombe_a_rich", "primary"),
        (-80, -30, GUA_UAG, "pombe_gua_uag", "pombe_gua_uag", "auxiliary"),
        (15, 61, GUA_UAG, "pombe_gua_uag", "pombe_gua_uag", "auxiliary"),
        (-80, -30, UAG, "pombe_uag", "pombe_uag", "auxiliary"),
        (15, 61, GUA, "pombe_gua", "pombe_gua", "auxiliary"),
        (-20, 21, None, "pombe_u_rich", "pombe_u_rich", "auxiliary"),
    ],
}
# How a budding-yeast site with both elements is reported.
BOTH = ("yeast_ee_pe", "yeast_ee_pe", "primary")
MODELS = (*STEPS, "NOT_ASSESSED")


def motif(sequence: Column, start: Column, model: str, families: dict[str, list[str]] | None = None) -> Column:
    """struct(motif, position, motif_type, search_level, motif_support, cleavage_context, u_rich_fraction) of a context under a model."""
    from terminus.functions.numeric import round_even

    if model not in MODELS:
        raise ValueError(f"unknown model: {model}")
    names = ("motif_type", "search_level", "motif_support")
    verdict = lambda kinds: [F.lit(k).alias(n) for k, n in zip(kinds, names)]
    blank = lambda kind: F.struct(F.lit(None).cast("string").alias("motif"), F.lit(None).cast("int").alias("position"), *[F.lit(kind).alias(n) for n in names])
    if model == "NOT_ASSESSED":
        found, cleavage, share = blank("not_assessed"), F.lit(""), F.lit(None).cast("double")
    else:
        text = F.upper(sequence)
        own = {id(UAG): (families or {}).get("UAG", UAG), id(GUA): (families or {}).get("GUA", GUA), id(GUA_UAG): (families or {}).get("GUA_UAG", GUA_UAG)}
        step = lambda a, b, m, kinds: rich_hexamer(text, start, a, b, *verdict(kinds)) if m is None else first_motif(text, start, a, b, own.get(id(m), m), *verdict(kinds))
        steps = [step(a, b, m, kinds) for a, b, m, *kinds in STEPS[model]]
        if model == "BUDDING_YEAST":
            steps.insert(0, F.when(steps[1].isNotNull(), step(*STEPS[model][0][:3], BOTH)))
        found = F.coalesce(*steps, blank("none"))
        cleavage = window(text, start, -1, 1)[0]
        share = round_even(fraction(window(text, start, -10, 16)[0], "T"), 4) if model == "LAND_PLANT" else F.lit(None).cast("double")
    return F.struct(*[found[n].alias(n) for n in ("motif", "position", *names)], cleavage.alias("cleavage_context"), share.alias("u_rich_fraction"))


def level(n_samples: Column, support: Column) -> tuple[Column, Column]:
    again, primary = n_samples >= 2, support == "primary"
    return (
        F.when(again & primary, "PAS-L1").when(again | primary, "PAS-L2").otherwise("PAS-L3"),
        F.when(again & primary, "recurrence_and_motif").when(again, "recurrence_only").when(primary, "motif_only").otherwise("baseline_call"),
    )


def sample_key(c: Column) -> Column:
    """A sample's name without differences of case, underscores and spaces."""
    return F.lower(F.trim(F.regexp_replace(F.replace(F.coalesce(c, F.lit("")), F.lit("_"), F.lit(" ")), r"\s+", " ")))


def clusters(detailed: DataFrame) -> DataFrame:
    """Clusters of a detailed table with their extent and number of samples; rows of one cluster that disagree are an error."""
    key = F.col("sample_id") if "sample_id" in detailed.columns else sample_key(F.col("sample"))
    same = ("unified_ID", "chromosome", "strand", "mode_site_position")
    own = detailed.groupBy("cluster_key").agg(
        *[F.min(c).alias(c) for c in same], F.max(F.struct(*same)).alias("_high"), F.min(F.struct(*same)).alias("_low"),
        F.min("original_site_position").alias("cluster_start"), F.max("original_site_position").alias("cluster_end"), F.count_distinct(key).alias("n_samples"),
    )
    fault = F.when(F.col("_high") != F.col("_low"), "rows that disagree").when(~F.col("mode_site_position").between(F.col("cluster_start"), F.col("cluster_end")), "a representative outside")
    checked = F.when(fault.isNotNull(), F.raise_error(F.concat(F.lit("cluster "), "cluster_key", F.lit(" has "), fault)))
    return own.withColumn("_ok", checked).where(F.col("_ok").isNull()).drop("_high", "_low", "_ok")


def contexts(sites: DataFrame, genome_tiles: DataFrame) -> DataFrame:
    """sites (chromosome, strand, mode_site_position) with context and context_start; a site off the genome has null."""
    sizes = genome_tiles.select("chromosome", "length").distinct()
    from terminus.sources.tables import alias_key

    sizes = sizes.select(alias_key(F.col("chromosome")).alias("_key"), F.col("length").alias("_length"))
    own = sites.withColumn("_key", alias_key(F.col("chromosome"))).join(sizes, "_key", "left").drop("_key")
    first, last, start = context_bounds(F.col("mode_site_position"), F.col("strand"), F.col("_length"))
    own = own.withColumns({"first": first, "last": last, "context_start": start})
    got = fetch(own, genome_tiles)
    piece = F.when(F.col("strand") == "-", reverse_complement(F.col("piece"))).otherwise(F.col("piece"))
    return got.withColumn("context", F.when(F.col("mode_site_position") <= F.col("_length"), piece)).drop("first", "last", "piece", "length", "_length")


def annotate(detailed: DataFrame, genome_tiles: DataFrame, model: str, families: dict | None = None) -> DataFrame:
    """The nineteen columns of an annotated cluster. A cluster off the genome ends the job."""
    own = contexts(clusters(detailed), genome_tiles)
    own = own.withColumn("context", F.coalesce("context", F.raise_error(F.concat(F.lit("no sequence for "), "cluster_key")).cast("string")))
    own = own.withColumn("m", motif(F.col("context"), F.col("context_start"), model, families))
    grade, basis = level(F.col("n_samples"), F.col("m.motif_support"))
    return own.select(
        "cluster_key", "unified_ID", "chromosome", "strand", "mode_site_position", "cluster_start", "cluster_end", display(F.col("context"), F.col("context_start")).alias("sequence"),
        F.col("m.motif").alias("pas_motif"), F.col("m.position").alias("pas_position"), F.col("m.motif_type").alias("pas_type"), F.col("m.search_level").alias("search_level"), F.lit(model.lower()).alias("motif_model"),
        F.col("m.cleavage_context").alias("cleavage_context"), F.col("m.u_rich_fraction").alias("u_rich_fraction"), "n_samples", F.col("m.motif_support").alias("motif_support"), grade.alias("pa_level"), basis.alias("pa_level_basis"),
    )
