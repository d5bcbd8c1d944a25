"""Sources to survey units, and the manifest that records where each unit went."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formspark import functions as fx
from formspark.functions.paths import CATEGORY_SUBDIRS

# Reason texts of the gates.
WORD_REASON = "a large handwritten 'Declined' marking was detected on this survey page."
SCRIBBLE_REASON = (
    "A large hand-drawn strikethrough/scribble was detected across the answer grid on this survey page, "
    "with no 'Declined' word written - treated as a voided/cancelled response; needs review to confirm "
    "the respondent meant to decline."
)
NO_CURRENT_REASON = (
    "this file sits under this source's Rejected/ subfolder, but re-checking its pages found no current "
    "reason to reject it - the ORIGINAL reason from the run that first produced it was never stored "
    "outside that run's own manifest row"
)
KEY = ["source_gcs_uri", "source_page_range"]
_UNIT = ["source_gcs_uri", "page_count", "unit_index", "page_start", "page_end", "source_page_range", "destination_folder", "output_name"]
VERDICT_KEY, VERDICTS = ["source_gcs_uri", "unit_index"], ["language_verdict", "content_verdict"]


def _source_name(uri: Column) -> Column:
    return fx.base_name(uri)


def _range(start: Column, end: Column) -> Column:
    return F.concat_ws("-", start.cast("string"), end.cast("string"))


def expand_units(sources: DataFrame, pages_per_unit: int, only_range: tuple[int, int] | None = None,
                 max_units: int | None = None) -> DataFrame:
    """Every survey unit of each well-formed source, in page order."""
    n, size = F.col("page_count"), pages_per_unit
    starts = F.sequence(F.lit(0), (n - size).cast("int"), F.lit(size))
    if only_range is not None:
        starts = F.filter(starts, lambda s: (s + 1 == only_range[0]) & (s + size == only_range[1]))
    if max_units is not None:
        starts = F.slice(starts, 1, max_units)
    units = sources.filter((n >= size) & (n % size == 0)).withColumn("start", F.explode(starts)).withColumn(
        "unit_index", (F.col("start") / size).cast("int") + 1
    )
    name = fx.stem(_source_name(F.col("source_gcs_uri")))
    return units.select(
        *sources.columns,
        "unit_index",
        (F.col("start") + 1).alias("page_start"),
        (F.col("start") + size).alias("page_end"),
        _range(F.col("start") + 1, F.col("start") + size).alias("source_page_range"),
        name.alias("destination_folder"),
        fx.unit_name(name, F.col("unit_index")).alias("output_name"),
    )


def malformed_sources(sources: DataFrame, verdicts: DataFrame, pages_per_unit: int,
                      language: str = "English") -> DataFrame:
    """One rejected whole-source row where the page count does not divide, is zero or is not known."""
    n = F.col("page_count")
    bad = sources.filter(n.isNull() | (n < 1) | (n % pages_per_unit != 0))
    first = verdicts.filter(F.col("unit_index") == 1).select(
        "source_gcs_uri", "language_verdict", "content_verdict"
    )
    uri = F.col("source_gcs_uri")
    reason = F.concat_ws(
        "; Also: ",
        F.concat(_source_name(uri), F.lit(" has "), F.coalesce(n.cast("string"), F.lit("an unknown number of")),
                 F.lit(f" page(s), which is not a multiple of {pages_per_unit} pages per survey")),
        F.when(~fx.language_ok(F.col("language_verdict")),
               F.lit(f"the PDF is in a language other than {language}")),
        fx.content_verdict(F.col("content_verdict"))["content_issue"],
    )
    return bad.join(first, "source_gcs_uri", "left").select(
        "source_gcs_uri",
        F.lit(1).alias("page_start"), n.cast("int").alias("page_end"),
        F.when(n > 0, _range(F.lit(1), n)).alias("source_page_range"),
        fx.stem(_source_name(uri)).alias("destination_folder"),
        F.lit(None).cast("string").alias("output_name"),
        F.lit("rejected").alias("output_category"),
        reason.alias("rejected_reason"),
        F.lit(None).cast("string").alias("needs_review_reason"),
    )


def _with_note(reason: str, note: Column) -> Column:
    return F.concat(F.lit(reason), F.coalesce(F.concat(F.lit(" Also, "), note, F.lit(".")), F.lit("")))


def with_verdicts(units: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Units with what the gates said of them, null where they said nothing."""
    return units.join(verdicts.select(*VERDICT_KEY, *VERDICTS), VERDICT_KEY, "left")


def categorise_units(units: DataFrame, verdicts: DataFrame, language: str = "English") -> DataFrame:
    """Category and reason of each unit: word, scribble, content issue, else normal."""
    return categorised(with_verdicts(units, verdicts), language)


def categorised(judged: DataFrame, language: str = "English") -> DataFrame:
    """As ``categorise_units``, for units that carry their verdicts."""
    return judged.select(*[c for c in judged.columns if c not in VERDICTS], *_fresh_outcome(language))


def _fresh_outcome(language: str) -> list[Column]:
    """``output_category``, ``rejected_reason`` and ``needs_review_reason`` as the verdicts have it."""
    content = fx.content_verdict(F.col("content_verdict"))
    marking, issue = content["decline_marking"], content["content_issue"]
    note = fx.language_note(F.col("language_verdict"), language)
    category = (
        F.when(marking.isNotNull(), F.lit("declined")).when(issue.isNotNull(), F.lit("rejected"))
        .otherwise(F.lit("normal"))
    )
    review = (
        F.when(marking == "WORD", _with_note(WORD_REASON, note))
        .when(marking == "SCRIBBLE", _with_note(SCRIBBLE_REASON, note))
        .when(issue.isNull(), note)
    )
    return [category.alias("output_category"), F.when(marking.isNull(), issue).alias("rejected_reason"),
            review.alias("needs_review_reason")]


def _placed_outcome(category: Column, language: str) -> list[Column]:
    """The same where the category is known from where the file lies, with the reasons that go with it."""
    content = fx.content_verdict(F.col("content_verdict"))
    note = fx.language_note(F.col("language_verdict"), language)
    scribble = F.coalesce(content["decline_marking"] == "SCRIBBLE", F.lit(False))
    declined = F.when(scribble, _with_note(SCRIBBLE_REASON, note)).otherwise(_with_note(WORD_REASON, note))
    return [category.alias("output_category"),
            F.when(category == "rejected", F.coalesce(content["content_issue"], F.lit(NO_CURRENT_REASON))).alias("rejected_reason"),
            F.when(category == "declined", declined).when(category == "normal", note).alias("needs_review_reason")]


def placed_or_fresh(judged: DataFrame, language: str = "English") -> DataFrame:
    """Outcome of units that carry ``place``, ``done`` and their verdicts: by place where their source is done."""
    pairs = zip(_placed_outcome(F.col("place.category"), language), _fresh_outcome(language), strict=True)
    names = ("output_category", "rejected_reason", "needs_review_reason")
    return judged.select(
        *[c for c in judged.columns if c not in (*VERDICTS, "place", "page_count", "unit_index")],
        *[F.when(F.col("done"), placed).otherwise(fresh).alias(name) for name, (placed, fresh) in zip(names, pairs, strict=True)])


def flag_duplicate_names(units: DataFrame) -> DataFrame:
    """Second and later units under one output name become rejected, with no destination.

    Copies are counted before the first is chosen, and the choice is a grouped
    minimum joined back, so one heavy name never sits in a single window. Units that
    are ``done``, where there is such a column, lie at their destination and are left alone.
    """
    columns = units.columns
    done = F.col("done") if "done" in columns else F.lit(False)
    # Dealt by name once, for the choice and for the rows that it is joined back to. The keys are never null and the choice's
    # condition stands in the aggregate: a filter, be it one inferred from the join, would sink into a plan of its own.
    named = {key: F.coalesce(column, F.lit("")) for key, column in (("of_source", "source_gcs_uri"), ("of_name", "output_name"))}
    copies = units.groupBy(*columns).agg(F.count("*").alias("copies")).withColumns(named).repartition(*named)
    order = F.struct("page_start", *[c for c in columns if c != "page_start"])
    chosen = F.min(F.when(F.col("output_name").isNotNull() & ~done, order))
    numbered = (
        copies.join(copies.groupBy(*named).agg(chosen.alias("first_unit")), [*named])
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    )
    keeps = done | F.col("output_name").isNull() | ((F.col("copy") == 1) & order.eqNullSafe(F.col("first_unit")))
    text = F.concat(F.lit("duplicate output name '"), F.col("output_name"), F.lit("' within this source PDF"))
    changed = {
        "output_category": F.when(keeps, F.col("output_category")).otherwise(F.lit("rejected")),
        "rejected_reason": F.when(keeps, F.col("rejected_reason")).otherwise(text),
        "needs_review_reason": F.when(keeps, F.col("needs_review_reason")),
    }
    return numbered.select(
        *[changed.get(c, F.col(c)).alias(c) for c in columns],
        (keeps & F.col("output_name").isNotNull()).alias("has_destination"),
    )


def manifest_rows(units: DataFrame, bucket: str, prefix: str, moved_at: Column) -> tuple[DataFrame, DataFrame]:
    """Manifest rows, and apart from them the rows that are rejected and for review at once."""
    uri, category = F.col("source_gcs_uri"), F.col("output_category")
    placed = F.col("has_destination") if "has_destination" in units.columns else F.col("output_name").isNotNull()
    path = fx.destination_path(F.lit(prefix), category, F.col("destination_folder"), F.col("output_name"))
    rows = units.select(
        F.substring(uri, 6, 1 << 30).alias("source_file"),
        "source_gcs_uri",
        F.date_format(moved_at, "MM/dd").alias("parsed_month_day"),
        "destination_folder",
        F.when(placed, F.concat(F.lit(f"gs://{bucket}/"), path)).alias("destination_gcs_uri"),
        moved_at.alias("moved_at"),
        F.to_date(moved_at).alias("moved_date"),
        "source_page_range",
        category.alias("output_category"),
        F.col("rejected_reason").isNotNull().alias("rejected"),
        "rejected_reason",
        F.col("needs_review_reason").isNotNull().alias("needs_review"),
        "needs_review_reason",
    )
    both = F.col("rejected") & F.col("needs_review")
    return rows.filter(~both), rows.filter(both)


def all_or_error(rows: DataFrame, broken: DataFrame) -> DataFrame:
    """``rows``; running it fails as soon as there is one row in ``broken``, so that none is lost in silence."""
    text = F.concat(F.lit("a unit is both rejected and for review: "), F.coalesce("source_gcs_uri", F.lit("?")),
                    F.lit(" pages "), F.coalesce("source_page_range", F.lit("?")))
    # Guarded by the condition itself: the order in which filters run is not fixed.
    fault = F.when(F.col("rejected") & F.col("needs_review"), F.raise_error(text))
    return rows.unionByName(broken.filter(fault.isNull()))


def settled(rows: DataFrame, broken: DataFrame, failures: Callable[[DataFrame], None] | None) -> DataFrame:
    """``rows``, once ``failures`` has taken the broken ones; without it a broken row is an error."""
    if failures is None:
        return all_or_error(rows, broken)
    failures(broken)
    return rows


def placed_units(sources: DataFrame, listing: DataFrame, pages_per_unit: int,
                 bucket: str, prefix: str) -> DataFrame:
    """Units that already have a file, with the first category root that holds it.

    Folder and name are read off the listed paths, so a unit is looked up once. A path below a category's folder can also
    be that of an ordinary source folder of the same name, so it stands for both.
    """
    return with_places(expand_units(sources.select("source_gcs_uri", "page_count").distinct(), pages_per_unit),
                       listing, bucket, prefix).filter("place IS NOT NULL").select(
                           *_UNIT, F.col("place.category").alias("output_category"), F.col("place.destination_gcs_uri"))


def with_places(units: DataFrame, listing: DataFrame, bucket: str, prefix: str) -> DataFrame:
    """Units with ``place`` (``category``, ``destination_gcs_uri``), null where no root holds a file of theirs."""
    base = F.concat(F.lit(f"gs://{bucket}/"), fx.norm_prefix(F.lit(prefix)))
    below = F.substring(F.col("uri"), F.length(base) + 1, F.length("uri"))
    places = F.array_compact(F.array(*[
        F.when(F.startswith(below, F.lit(folder)), F.struct(
            F.lit(i).alias("root_order"), F.lit(category).alias("category"), F.col("uri").alias("destination_gcs_uri"),
            F.substring(below, F.lit(len(folder) + 1), F.length(below)).alias("path")))
        for i, (category, folder) in enumerate(CATEGORY_SUBDIRS.items())]))
    listed = listing.filter(F.startswith("uri", base)).select(F.explode(places).alias("p")).groupBy("p.path").agg(
        F.min(F.struct("p.root_order", "p.category", "p.destination_gcs_uri")).alias("place"))
    return units.join(listed, F.concat("destination_folder", F.lit("/"), "output_name") == F.col("path"), "left") \
        .select(*units.columns, "place")


def complete_sources(sources: DataFrame, listing: DataFrame, pages_per_unit: int,
                     bucket: str, prefix: str) -> DataFrame:
    """Sources all of whose units have a file somewhere."""
    return completed(placed_units(sources, listing, pages_per_unit, bucket, prefix), pages_per_unit)


def completed(placed: DataFrame, pages_per_unit: int) -> DataFrame:
    """Sources all of whose units are among the placed ones."""
    return (
        placed.groupBy("source_gcs_uri").agg(F.count("*").alias("units_found"), F.max("page_count").alias("page_count"))
        .filter(F.col("units_found") * pages_per_unit == F.col("page_count"))
        .select("source_gcs_uri")
    )


def reconcile_manifest(sources: DataFrame, listing: DataFrame, verdicts: DataFrame, pages_per_unit: int,
                       bucket: str, prefix: str, language: str = "English") -> DataFrame:
    """Units of complete sources: category from where the file lies, reasons from fresh verdicts."""
    return reconciled(with_verdicts(placed_units(sources, listing, pages_per_unit, bucket, prefix), verdicts), language)


def reconciled(judged: DataFrame, language: str = "English") -> DataFrame:
    """Placed units that carry their verdicts as rows of the manifest, but for the run's own columns."""
    category, rejected, review = _placed_outcome(F.col("output_category"), language)
    return judged.select("source_gcs_uri", "unit_index", "page_start", "page_end", "source_page_range", "destination_folder",
                         "output_name", category, "destination_gcs_uri", rejected, review)


def superseded(old_manifest: DataFrame, new_rows: DataFrame, listing: DataFrame, bucket: str) -> DataFrame:
    """Old destinations that a new, existing one takes over; the list for deletion."""
    root = f"gs://{bucket}/"
    old = old_manifest.select(
        *[F.col(k).alias(f"old_{k}") for k in KEY], F.col("destination_gcs_uri").alias("old_uri")
    ).filter(F.col("old_uri").startswith(root))
    new = new_rows.select(*KEY, F.col("destination_gcs_uri").alias("new_uri")).filter(
        F.col("new_uri").startswith(root)
    ).distinct()
    pairs = old.join(
        new,
        (old.old_source_gcs_uri.eqNullSafe(new.source_gcs_uri))
        & (old.old_source_page_range.eqNullSafe(new.source_page_range))
        & (old.old_uri != new.new_uri),
    ).select(*KEY, "old_uri", "new_uri").distinct()
    existing = listing.select("uri").distinct()
    for side in ("new_uri", "old_uri"):
        pairs = pairs.join(existing, pairs[side] == existing.uri, "left_semi")
    return pairs


def date_folders(listing: DataFrame, root: str, uri: str = "uri") -> DataFrame:
    """Distinct folder names on the paths below a root that are dates, sorted."""
    anchored = root if root.endswith("/") else root + "/"
    below = listing.filter(F.col(uri).startswith(anchored) & F.lower(F.col(uri)).endswith(".pdf"))
    parts = F.split(F.substring(F.col(uri), len(anchored) + 1, 1 << 30), "/")
    folders = below.select(F.explode(F.slice(parts, F.lit(1), F.size(parts) - 1)).alias("folder")).distinct()
    return folders.withColumn("folder_date", fx.strict_folder_date(F.col("folder"))).filter(
        "folder_date IS NOT NULL"
    ).orderBy("folder")


def infer_year(folders: DataFrame, default: int) -> DataFrame:
    """Most common year of the date folders, the later on a tie, else the default."""
    years = folders.groupBy(F.year("folder_date").alias("year")).agg(F.count("*").alias("n"))
    return years.agg(
        F.coalesce(F.max_by("year", F.struct("n", "year")), F.lit(default)).alias("year"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("folders"),
    )


def plan_sources(sources: DataFrame, complete: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split sources into those to reconcile and those to expand afresh."""
    done = complete.select("source_gcs_uri").distinct()
    return (
        sources.join(done, "source_gcs_uri", "left_semi"),
        sources.join(done, "source_gcs_uri", "left_anti"),
    )


def run_totals(manifest: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """Counts of a run: units, units per category and flag, sources that failed."""
    rows = manifest.select("output_category", "rejected", "needs_review", F.lit(False).alias("failed"))
    if errors is not None:
        rows = rows.unionByName(errors.select(F.lit(True).alias("failed")), allowMissingColumns=True)
    unit, category = ~F.col("failed"), F.col("output_category")
    return rows.agg(
        F.count_if(unit).alias("outputs"),
        *[F.count_if(category == c).alias(c) for c in CATEGORY_SUBDIRS],
        F.count_if(F.col("rejected")).alias("rejected_flag"),
        F.count_if(F.col("needs_review")).alias("needs_review"),
        F.count_if(F.col("failed")).alias("failed_sources"),
    )


def usage_totals(calls: DataFrame, by: tuple[str, ...] = (), rollup: bool = False) -> DataFrame:
    """Requests and tokens; a call without any usage does not count as a request."""
    prompt, output = F.col("prompt_tokens"), F.col("output_tokens")
    total = F.col("total_tokens") if "total_tokens" in calls.columns else (
        F.coalesce(prompt, F.lit(0)) + F.coalesce(output, F.lit(0))
    )
    grouped = calls.rollup(*by) if rollup else calls.groupBy(*by)
    zero = F.lit(0).cast("bigint")
    return grouped.agg(
        F.count_if(prompt.isNotNull() | output.isNotNull()).alias("requests"),
        *[F.coalesce(F.sum(c).cast("bigint"), zero).alias(name) for c, name in (
            (prompt, "prompt_tokens"), (output, "output_tokens"), (total, "total_tokens"))],
    )
