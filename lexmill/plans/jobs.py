"""The jobs a user runs. Each takes tables and returns the new snapshots by table name.

No job reads the clock: `as_of` is a timestamp literal, so a repeated run gives the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import ids, jsondoc, scoring, text
from lexmill.functions.rowwise import once
from lexmill.operators import audit, consolidate, patterns, select, upsert, words
from lexmill.operators import enumerate as cursors_
from lexmill.operators.skew import Lookup
from lexmill.plans import cascade
from lexmill.session import hashed, materialize


def _stamp(as_of: str) -> Column:
    return F.lit(as_of).cast("timestamp_ntz")


def with_ids(registry: DataFrame) -> DataFrame:
    return registry.withColumn("document_id", ids.document_id(F.col("type"), F.col("year"), F.col("number")))


@dataclass(frozen=True)
class FetchOptions:
    """`max_number` is where a new cursor starts; `per_cursor` and `max_per_run` limit a run, None not at all."""

    mode: str = "previous"  # or "current"
    year: int = 2025
    max_number: int = 2000
    per_cursor: int | None = None
    max_per_run: int | None = 8000
    min_year: int = 1960
    base_url: str = ""
    force: bool = False
    type_: str | None = None


def plan_fetch(cursors: DataFrame, not_found: DataFrame, options: FetchOptions) -> tuple[DataFrame, DataFrame]:
    """(candidates, advanced cursors) of a run; candidates carry document_id and url.

    A current-year run looks at the whole year and skips nothing.
    """
    current = options.mode == "current"
    cursor_type = f"fetch-{options.mode}"
    start_year = options.year if current else options.year - 1
    start = cursors_.start_cursors(cursors, cursors.sparkSession, cursor_type, start_year, options.max_number)
    start = start.where(ids.type_filter(F.col("document_type"), options.type_))
    quota = None if current else options.max_per_run
    skip = not_found.limit(0) if current else not_found
    chosen = materialize(cursors_.candidates(start, skip, options.per_cursor, quota), "candidates")
    moved = cursors_.advance_cursors(
        start, chosen, options.max_number, options.min_year, options.per_cursor, quota
    ).select(F.lit(cursor_type).alias("cursor_type"), "document_type", "current_year", "current_number")
    key = (F.col("document_type"), F.col("year"), F.col("number"))
    candidates = chosen.select(
        F.col("document_type").alias("type"),
        "year",
        "number",
        ids.document_id(*key).alias("document_id"),
        ids.document_url(options.base_url, *key).alias("url"),
    )
    return candidates, moved


def probe_outcomes(candidates: DataFrame, probes: DataFrame) -> DataFrame:
    """Candidates with status, exists and the effective url, from the probe log.

    `probes` has document_id, attempt, code, padded; a candidate without a probe is left out.
    """
    from lexmill.operators.throttle import retry_outcome

    plain = retry_outcome(probes.where(~F.col("padded")), "document_id", "attempt", "code").select("document_id", "code")
    padded = retry_outcome(probes.where("padded"), "document_id", "attempt", "code").select(
        "document_id", F.col("code").alias("padded_code")
    )
    outcome = ids.probe_status(F.col("code"), F.col("number"), F.col("padded_code"))
    joined = candidates.join(plain, "document_id").join(padded, "document_id", "left")
    base = F.regexp_extract("url", r"^(.*)/[^/]+$", 1)
    padded_id = F.concat_ws("-", "type", F.col("year").cast("string"), F.lpad(F.col("number").cast("string"), 2, "0"))
    return joined.withColumn("p", outcome).select(
        *candidates.columns[:-1],
        F.when(F.col("p.padded"), F.concat_ws("/", base, padded_id)).otherwise(F.col("url")).alias("url"),
        "p.status",
        "p.exists",
    )


def run_fetch(
    registry: DataFrame,
    fetch_results: DataFrame,
    cursors: DataFrame,
    not_found: DataFrame,
    probes: DataFrame,
    as_of: str,
    options: FetchOptions = FetchOptions(),
) -> dict[str, DataFrame]:
    """Enumerate, classify, upsert. A rate-limited id is neither final nor counted as missing.

    A candidate without a probe has no result; its cursor waits for it.
    """
    candidates, moved = plan_fetch(cursors, not_found, options)
    moved = cursors_.hold_at_unprobed(moved, candidates, probes)
    outcomes = materialize(probe_outcomes(candidates, probes), "outcomes")
    results = outcomes.select(
        "document_id",
        F.col("type").alias("document_type"),
        "year",
        "number",
        "url",
        ids.result_status(F.col("status")).alias("status"),
        "exists",
        _stamp(as_of).alias("fetched_at"),
        F.lit(None).cast("string").alias("error_message"),
    )
    rows = outcomes.select("type", "year", "number", "url", ids.status_or_pending(F.col("status")).alias("status"), "exists")
    rows = rows.withColumns({c: F.lit(None).cast("string") for c in ("pdf_path", "ocr_path", "sha256")})
    out = {
        "fetch_results": upsert.upsert_fetch_results(fetch_results, results, options.force).drop("change"),
        "registry": upsert.upsert_registry(registry, rows.select(*registry.columns), options.force).drop("change"),
        "cursors": upsert.merge(
            cursors, moved.withColumn("updated_at", _stamp(as_of)), ["cursor_type", "document_type"], upsert.always
        ).drop("change"),
    }
    if options.mode == "previous":
        gone = outcomes.where(~F.col("exists") & (F.col("status") != "RATE_LIMITED")).select(
            F.col("type").alias("document_type"), "year", "number", _stamp(as_of).alias("detected_at")
        )
        out["not_found"] = upsert.insert_ignore(not_found, gone, ["document_type", "year", "number"])
    return out


def run_download(
    registry: DataFrame,
    inventory: DataFrame,
    download_results: DataFrame,
    payloads: DataFrame,
    as_of: str,
    root: str = "/data",
    type_: str | None = None,
    limit: int | None = None,
    force: bool = False,
) -> dict[str, DataFrame]:
    """Record the payloads (document_id, content) of selected documents and mark them DOWNLOADED."""
    known = with_ids(registry)
    chosen = select.to_download(known, inventory, download_results, type_, limit, force)
    got = chosen.join(select.usable_payloads(payloads), "document_id").select(
        "document_id",
        ids.download_url(F.col("url")).alias("url"),
        ids.artifact_path(root, "pdf", F.col("type"), F.col("document_id")).alias("pdf_path"),
        text.payload_hash(F.col("content")).alias("sha256"),
        F.length("content").cast("long").alias("file_size"),
        _stamp(as_of).alias("downloaded_at"),
        F.lit(None).cast("string").alias("error_message"),
    )
    got = materialize(got, "downloads")  # hashes are computed once; contents are not carried on
    present = inventory.where("kind = 'pdf'").select("document_id").distinct()
    marks = got.select("document_id", F.col("pdf_path").alias("__path"), F.col("sha256").alias("__sha"))
    hit = F.col("__path").isNotNull()
    updated = known.join(marks, "document_id", "left").withColumns(
        {
            "status": F.when(hit, "DOWNLOADED").otherwise(F.col("status")),
            "pdf_path": F.coalesce("__path", "pdf_path"),
            "sha256": F.coalesce("__sha", "sha256"),
        }
    )
    return {
        "download_results": upsert.upsert_downloads(download_results, got, present, force).drop("change"),
        "registry": updated.select(*registry.columns),
    }


@dataclass(frozen=True)
class ExtractOptions:
    variant: str = "extractor"
    strict: bool = False  # no corrections, no titles
    corrections: tuple = ()
    signatories: tuple = ()
    limit: int | None = None
    type_: str | None = None
    within_mandate: bool = False
    stop_at_footer: bool = False
    anchor_to_footer: bool = False
    force_ids: DataFrame | None = field(default=None, compare=False)


def extract_documents(
    texts: DataFrame,
    dictionary: DataFrame | Lookup,
    as_of: str,
    options: ExtractOptions = ExtractOptions(),
    with_words: bool = True,
) -> DataFrame:
    """(document_id, type, year, number, json, confidence, source, n_articles[, unknown_words]) of each text.

    `texts` has document_id, type, year, number, text. Texts are hashed by document once; the word
    statistics and the articles both start from that layout and meet without moving again.
    """
    if not options.strict:
        texts = patterns.correct(texts, options.corrections)
    body = F.col("text")
    date = text.french_date(body, options.anchor_to_footer)
    texts = patterns.with_signatories(texts, options.signatories, date.cast("date") if options.within_mandate else None)
    texts = texts.withColumnRenamed("signatories", "__signed")
    texts = hashed(texts, "document_id")
    # The other columns travel as grouping columns, which keeps both sides of the join on one exchange.
    stats = words.word_quality(
        texts, dictionary, "document_id", ["type", "year", "number"], variant=options.variant, with_words=with_words
    ).select("document_id", "unknown_rate", "n_unknown_words", *["unknown_words"] * with_words)
    docs = text.with_articles(texts, stop_at_footer=options.stop_at_footer)
    signed = F.col("__signed")
    indexes = F.transform("articles", lambda a: a["index"])
    score = scoring.confidence(
        F.size("articles"),
        scoring.sequence_score(indexes, options.variant),
        F.length("text"),
        scoring.unknown_penalty(F.col("unknown_rate"), F.col("n_unknown_words"), options.variant),
        text.legal_term_count(body, variant=options.variant),
    )
    # The narrow side becomes the hash table, so whole texts are never sorted.
    joined = once(docs.join(stats.hint("shuffle_hash"), "document_id"), confidence=score, signatories=signed)
    document = jsondoc.build_document(
        F.col("document_id"), F.col("type"), F.col("year"), F.col("number"), F.col("confidence"),
        F.lit("OCR"), F.lit(as_of), F.col("articles"), F.col("signatories"),
        text.law_title(body, options.strict), date, text.promulgation_city(body),
    )
    return once(joined, json=document).select(
        "document_id",
        "type",
        "year",
        "number",
        "json",
        "confidence",
        F.lit("OCR").alias("source"),
        F.size("articles").alias("n_articles"),
        *["unknown_words"] * with_words,
    )


def run_extract(
    registry: DataFrame,
    texts: DataFrame,
    extractions: DataFrame,
    dictionary: DataFrame,
    known_words: DataFrame,
    as_of: str,
    options: ExtractOptions = ExtractOptions(),
    corrected_text: DataFrame | None = None,
    corrected_json: DataFrame | None = None,
    full: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Extract and score the downloaded documents, choose the best result, keep the better one.

    Texts without any article, or whose best result is below the bar, end as FAILED.
    """
    known = with_ids(registry)
    waiting = known.where((F.col("status") == "DOWNLOADED") & ids.type_filter(F.col("type"), options.type_))
    if options.force_ids is not None:
        waiting = select.target_documents(known, options.force_ids, ["DOWNLOADED"], force=True)
    chosen = select.newest_first(waiting, options.limit) if options.limit else waiting
    input_ = texts.select("document_id", "text").join(
        chosen.select("document_id", "type", "year", "number"), "document_id"
    )
    # Extraction and choice are one job: its documents are hashed by id, the alternatives meet them there,
    # and what is stored is the JSON that won, once.
    # Lists of unknown words are not part of it: they would sort all words of the texts.
    dictionary = words.stored_dictionary(dictionary)
    found = extract_documents(input_, dictionary, as_of, options, with_words=False)
    extracted = materialize(cascade.choose(found, corrected_text, corrected_json, full, keep=["n_articles"]), "extractions")
    accepted = extracted.where("accepted and n_articles > 0").select("document_id", "json", "confidence", "source")
    done = accepted.select("document_id", F.lit("EXTRACTED").alias("__next"))
    failed = (
        extracted.select("document_id")
        .join(accepted.select("document_id"), "document_id", "left_anti")
        .select("document_id", F.lit("FAILED").alias("__next"))
    )
    moved = known.join(done.unionByName(failed), "document_id", "left")
    read = input_ if options.strict else patterns.correct(input_, options.corrections)
    seen = words.unknown_words(read, dictionary, "document_id", options.variant) if dictionary.size else known_words.limit(0)
    return {
        "extractions": upsert.keep_better(extractions, accepted).drop("change"),
        "registry": moved.withColumn("status", F.coalesce("__next", "status")).select(*registry.columns),
        "unrecognized_words": words.grow_known(seen, known_words),
    }


def run_consolidate(
    registry: DataFrame,
    extractions: DataFrame,
    metadata: DataFrame,
    articles: DataFrame,
    signatories: DataFrame,
    as_of: str,
    type_: str | None = None,
    prune_stale: bool = False,
) -> dict[str, DataFrame]:
    """Move extracted documents into the consolidated tables."""
    known = with_ids(registry)
    ready = known.where((F.col("status") == "EXTRACTED") & ids.type_filter(F.col("type"), type_))
    parsed = materialize(consolidate.parse(extractions, ready), "parsed")
    out = consolidate.consolidate(parsed, metadata, articles, signatories, _stamp(as_of), prune_stale)
    marks = parsed.select(
        "document_id", consolidate.next_status(F.col("status"), F.col("readable")).alias("__next")
    )
    moved = known.join(marks, "document_id", "left").withColumn("status", F.coalesce("__next", "status"))
    out["registry"] = moved.select(*registry.columns)
    return out


def quality_figures(extractions: DataFrame, derive: bool = True) -> DataFrame:
    """confidence, sequence_issues, unknown_rate and n_articles of the stored JSON.

    With `derive`, sequence issues that are not written there are counted from the article indexes.
    """
    # Each level of the JSON is parsed once, whatever the number of figures read from it.
    rooted = jsondoc.with_root(extractions.select("document_id", "json"))
    rooted = once(rooted, meta=F.from_json(F.col("root")["_metadata"], "map<string,string>"))
    rooted = once(rooted, issues=F.from_json(F.col("meta")["sequenceIssues"], "gaps int, duplicates int, outOfOrder int"))
    written = F.col("issues.gaps") + F.col("issues.duplicates") + F.col("issues.outOfOrder")
    if derive:
        rooted = once(rooted, indexes=F.when(written.isNull(), jsondoc.article_indexes(F.col("root"))))
        rooted = once(rooted, counts=scoring.sequence_counts(F.col("indexes")))
        written = F.coalesce(written, F.col("counts.gaps") + F.col("counts.duplicates") + F.col("counts.inversions"))
    return rooted.select(
        "document_id",
        F.col("meta")["confidence"].try_cast("double").alias("confidence"),
        written.alias("sequence_issues"),
        F.col("meta")["unrecognizedWordsRate"].try_cast("double").alias("unknown_rate"),
        F.coalesce(F.json_array_length(F.col("root")["articles"]), F.lit(0)).alias("n_articles"),
    )


def run_fix(
    registry: DataFrame,
    inventory: DataFrame,
    download_results: DataFrame,
    extractions: DataFrame,
    critical_first: bool = False,
    route_inconsistent: bool = False,
    stuck: Column | None = None,
    limit: int | None = None,
) -> dict[str, DataFrame]:
    """Detect issues over the whole registry and roll statuses back.

    `stuck` is a condition that restricts the waiting checks, e.g. on an `updated_at` column.
    `limit` audits only that many rows.
    """
    known = with_ids(registry)
    scope = known if limit is None else known.limit(limit)
    flagged = select.with_presence(scope, inventory, download_results)
    docs = flagged.join(quality_figures(extractions), "document_id", "left")
    detectors = audit.status_issues(stuck) + audit.file_issues() + audit.quality_issues()
    planned = audit.plan_repairs(audit.detect(docs, detectors), critical_first, route_inconsistent)
    planned = materialize(planned.select("document_id", "fixes", "final_status"), "repairs")
    moved = known.join(planned.select("document_id", "final_status"), "document_id", "left")
    return {
        "fix_results": audit.fix_rows(planned),
        "registry": moved.withColumn("status", F.coalesce("final_status", "status")).select(*registry.columns),
    }


def run_full(tables: dict[str, DataFrame], wanted: DataFrame, as_of: str, options: ExtractOptions = ExtractOptions()) -> dict[str, DataFrame]:
    """Take the named documents (document_id) through download, extraction and consolidation.

    `tables` holds every state table plus texts, payloads, inventory, probe_results and dictionary.
    """
    t = dict(tables)
    named = wanted.select("document_id").distinct()
    parsed = named.select("document_id", ids.parse_document_id(F.col("document_id")).alias("k")).where("k IS NOT NULL")
    candidates = parsed.select("k.type", "k.year", "k.number", "document_id", F.col("document_id").alias("url"))
    unseen = cursors_.not_yet_seen(candidates, t["fetch_results"], ["document_id"])
    outcomes = materialize(probe_outcomes(unseen, t["probe_results"]), "outcomes")
    rows = outcomes.select("type", "year", "number", "url", "status", "exists").withColumns(
        {c: F.lit(None).cast("string") for c in ("pdf_path", "ocr_path", "sha256")}
    )
    t["registry"] = upsert.upsert_registry(t["registry"], rows.select(*t["registry"].columns)).drop("change")
    results = outcomes.select(
        "document_id", F.col("type").alias("document_type"), "year", "number", "url", "status", "exists",
        _stamp(as_of).alias("fetched_at"), F.lit(None).cast("string").alias("error_message"),
    )
    t["fetch_results"] = upsert.upsert_fetch_results(t["fetch_results"], results).drop("change")
    mine = t["payloads"].join(named, "document_id", "left_semi")
    t.update(run_download(t["registry"], t["inventory"], t["download_results"], mine, as_of))
    t["registry"] = materialize(t["registry"], "registry")
    texts = t["texts"].join(named, "document_id", "left_semi")
    t.update(run_extract(t["registry"], texts, t["extractions"], t["dictionary"], t["unrecognized_words"], as_of, options))
    t["registry"], t["extractions"] = materialize(t["registry"], "registry"), materialize(t["extractions"], "extractions")
    mine = t["extractions"].join(named, "document_id", "left_semi")
    t.update(
        run_consolidate(
            t["registry"], mine, t["consolidated_metadata"], t["consolidated_articles"],
            t["consolidated_signatories"], as_of,
        )
    )
    return t
