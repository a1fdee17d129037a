"""From folders of subtitle files to clean, split records: discover, statistics, extract, clean, split."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subloom.functions import chars, tags
from subloom.operators import corpus, discover, reorder, rules, split
from subloom.plans import report
from subloom.session import stored
from subloom.sources import ass, files, records, srt

DEFAULT_OUTPUT = "output"
CORPUS_ORDER = ["root_no", "low", "path", "start", "event_index", "line_no"]


def load_files(spark: SparkSession, roots: Sequence[str]) -> DataFrame:
    """root_no, root, path, extension, text, sha1 and what the decoder found, of all subtitle files; a missing root raises."""
    for r in roots:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(str(r))
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(path) or not fs.getFileStatus(path).isDirectory():
            raise FileNotFoundError(f"not a directory: {r}")
    found = files.with_text(files.scan(spark, [str(r) for r in roots])).drop("content")
    return found.withColumn("extension", F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1)))


def unread_files(spark: SparkSession, roots: Sequence[str], found: DataFrame) -> list[dict[str, str]]:
    """path and error of the files below the roots that are not among those found: a bad file stops nothing."""
    return [r.asDict() for r in files.unread(spark, [str(r) for r in roots], found).orderBy("path").collect()]


def load_events(found: DataFrame, key: str = "path") -> DataFrame:
    """Events of documents and cues alike."""
    is_srt = F.col("extension") == ".srt"
    parsed = ass.parse_events(files.lines(found.filter(~is_srt), key), key)
    return parsed.unionByName(srt.parse_events(found.filter(is_srt), key))


def discover_files(found: DataFrame, events: DataFrame) -> DataFrame:
    """Files with language, disposition and, where kept, id."""
    script = discover.script_language(events, "path").select("path", "detected")
    out = discover.with_language(discover.path_parts(found.select("root_no", "root", "path", "extension", "sha1")).join(script, "path", "left"))
    out = stored(discover.with_wanted_id(discover.with_disposition(out)))
    ids = discover.with_ids(out.filter("disposition = 'kept'")).select("root_no", "path", "id")
    return out.join(ids, ["root_no", "path"], "left")


def manifest(told: DataFrame, roots: Sequence[str]) -> dict[str, Any]:
    """The manifest: one small row a file, in order of root and path."""
    rows = told.select("root_no", "path", "id", "sha1", "language", "language_source", "disposition", "reason", "duplicate_of").orderBy("root_no", F.lower("path"), "path").collect()
    return {
        "roots": [str(r) for r in roots],
        "files": [{"id": r["id"], "path": r["path"], "sha1": r["sha1"], "language_source": r["language_source"]} for r in rows if r["disposition"] == "kept"],
        "skipped": [{"path": r["path"], "language": r["language"], "reason": r["reason"]} for r in rows if r["disposition"] == "skipped"],
        "duplicates": [{"sha1": r["sha1"], "path": r["path"], "duplicate_of": r["duplicate_of"]} for r in rows if r["disposition"] == "duplicate"],
    }


def load_manifest(path: str) -> dict[str, Any]:
    return json.loads(Path(path).read_text(encoding="utf-8"))


def statistics(kept: DataFrame, events: DataFrame, told: dict[str, Any], failed: Sequence[dict[str, str]] = ()) -> dict[str, Any]:
    """Statistics of kept files (id, path, extension), those without events included; failed: the files not read."""
    e = events.withColumn("p", tags.protect("text"))
    e = e.withColumns({"translatable": tags.is_translatable_struct(F.col("p")), "plain": chars.one_line(F.col("p.plain"))})
    numbers = ["dialogue_count", "translatable_count", "words", "chars", "avg_chars", "avg_words"]
    per = stored(kept.select("id", "path", "extension").join(corpus.file_statistics(e, "path"), "path", "left").fillna(0, numbers))
    t = per.agg(F.count(F.lit(1)).alias("files"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in numbers[:4]]).first()
    n = t["translatable_count"]
    return {
        "files": t["files"],
        "extensions": {r["extension"]: r["count"] for r in per.groupBy("extension").count().orderBy("extension").collect()},
        "skipped": {k: sum(1 for s in told["skipped"] if s["reason"] == k) for k in ("not_english", "language_unknown")},
        "duplicates": len(told["duplicates"]),
        "dialogue_entries": t["dialogue_count"],
        "translatable_entries": n,
        "words": t["words"],
        "characters": t["chars"],
        "average_subtitle_length": {"chars": round(t["chars"] / n, 2) if n else 0.0, "words": round(t["words"] / n, 2) if n else 0.0},
        "failed": list(failed),
        "per_file": [r.asDict() for r in per.select("id", "path", *numbers).orderBy("id").collect()],  # one small row a file, as in the manifest
    }


def extract(kept: DataFrame, events: DataFrame, cfg: rules.ExtractConfig = rules.ExtractConfig()) -> tuple[DataFrame, DataFrame]:
    """Records with their place in the corpus, and the Dialogue events of each file by drop reason."""
    of_file = kept.select("path", "id", "root_no", F.lower("path").alias("low"))
    judged = rules.with_drop_reason(events.filter("kind = 'Dialogue'"), cfg).join(of_file, "path").withColumn("movie_id", F.col("id"))
    rows = corpus.to_records(judged.filter("drop_reason IS NULL"), keep=["root_no", "low", "path", "line_no"])
    counts = judged.groupBy("movie_id", F.coalesce("drop_reason", F.lit("extracted")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    return rows, counts


def _write_json(path: Path, value: Any) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(value, ensure_ascii=False, indent=2), encoding="utf-8")


def clean(rows: DataFrame, order: list[str], cfg: rules.CleanConfig) -> tuple[DataFrame, dict[str, int], list[tuple[str, int]]]:
    """Classified and deduplicated records, the number of each status, and the reasons by count."""
    out = stored(corpus.deduped(rows, order, "text", cfg))
    statuses = {r["status"]: r["n"] for r in corpus.status_counts(out).collect()}
    reasons = [(r["reason"], r["n"]) for r in corpus.reason_counts(out, order).orderBy(F.desc("n"), "first_seen").collect()]
    return out, statuses, reasons


def write_splits(rows: DataFrame, order: list[str], out: str, ratios: tuple[float, ...], seed: int, forced: Iterable[str]) -> dict[str, Any]:
    """Records in a folder for each split, and the split manifest."""
    forced = list(forced or [])
    parts, assignment = split.with_split(rows, order, ratios, seed, forced)
    parts = stored(parts)
    for s in split.SPLITS:
        records.write_jsonl(parts.filter(F.col("split") == s).select(*[F.col(f"`{c}`") for c in records.RECORD.names if c in ("text", "context_before", "context_after", "speaker", "movie_id", "start", "end")]), f"{out}/{s}")
    told = {r["split"]: r for r in split.split_summary(parts).collect()}
    of = lambda s, k: told[s][k] if s in told else 0
    found = {
        "seed": seed,
        "ratios": dict(zip(split.SPLITS, ratios, strict=True)),
        "forced_test_movies": sorted(set(forced)),
        "line_counts": {s: of(s, "lines") for s in split.SPLITS},
        "line_shares": {s: of(s, "line_share") for s in split.SPLITS},
        "movie_counts": {s: n for s in split.SPLITS if (n := sum(1 for a in assignment.values() if a == s))},
        "movies": {s: sorted(m for m, a in assignment.items() if a == s) for s in split.SPLITS},
        "assignment": assignment,
    }
    _write_json(Path(out) / "split_manifest.json", found)
    return found


def run_pipeline(spark: SparkSession, roots: Sequence[str], out: str = DEFAULT_OUTPUT, seed: int = 42, ratios: tuple[float, ...] = split.RATIOS, test_movies: Iterable[str] = (), dedupe: bool = True) -> dict[str, Any]:
    """Everything below `out`. Episodes of earlier runs stay in `extracted` but aren't mixed in; files that can't be read
    are listed as failed and stop nothing."""
    target = Path(out)
    found = stored(load_files(spark, roots))
    failed = unread_files(spark, roots, found)
    events = stored(load_events(found))
    told = stored(discover_files(found, events))
    listed = manifest(told, roots)
    _write_json(target / "files.json", listed)
    kept = told.filter("disposition = 'kept'")
    stats = statistics(kept, events, listed, failed)
    _write_json(target / "reports" / "dataset_stats.json", stats)
    (target / "reports" / "dataset_stats.md").write_text(report.statistics_report(stats), encoding="utf-8")

    rows, drops = extract(kept, events)
    rows = stored(rows)
    records.write_jsonl(rows.select(*[F.col(f"`{c}`") for c in records.RECORD.names], F.col("movie_id").alias("episode")), f"{out}/extracted", by="episode")
    dropped = {r["reason"]: r["n"] for r in drops.groupBy("reason").agg(F.sum("n").alias("n")).collect()}
    extracted = dropped.pop("extracted", 0)
    dropped = {k: dropped.get(k, 0) for k in ("not_translatable", "skipped_style", "skipped_effect", "bad_timestamp")}
    movies: dict[str, dict[str, int]] = {}
    for r in drops.collect():  # one row a file and reason
        movies.setdefault(r["movie_id"], {})[r["reason"]] = r["n"]
    per = {m: {"dialogue_events": sum(v.values()), "extracted": v.get("extracted", 0), **{k: v.get(k, 0) for k in dropped}} for m, v in sorted(movies.items())}
    _write_json(target / "extract_summary.json", {"movies": per, "total_lines": extracted, "dropped": dropped, "failed": failed})

    cfg = rules.CleanConfig(dedupe=dedupe)
    cleaned, statuses, reasons = clean(rows, CORPUS_ORDER, cfg)
    for s in ("clean", "review", "rejected"):
        records.write_jsonl(cleaned.filter(F.col("status") == s).select(*[F.col(f"`{c}`") for c in records.RECORD.names], "status", "reasons"), f"{out}/cleaned/{s}")
    (target / "reports" / "cleaning_report.md").write_text(report.cleaning_report(statuses, reasons, cfg), encoding="utf-8")
    parts = write_splits(cleaned.filter("status = 'clean'"), CORPUS_ORDER, out, ratios, seed, test_movies)
    return {
        "out": str(out),
        "files": len(listed["files"]),
        "skipped": len(listed["skipped"]),
        "duplicates": len(listed["duplicates"]),
        "stats": {k: stats[k] for k in ("dialogue_entries", "translatable_entries", "words")},
        "extracted": extracted,
        "dropped": dropped,
        "failed": failed,
        "clean": statuses.get("clean", 0),
        "review": statuses.get("review", 0),
        "rejected": statuses.get("rejected", 0),
        "top_reject_reasons": reasons[:8],
        "split": parts["line_counts"],
    }


def collect_top_lines(spark: SparkSession, paths: Sequence[str], out: str | None = None, dry_run: bool = False) -> list[tuple[str, int, bool, str]]:
    """path, lines moved, whether the content changed, and an error, of each document; files are written on the driver.

    Files of a folder (not of its subfolders) ending in .ass, or files named. Only changed files are written, all where
    an output folder is given, none on a dry run.
    """
    named = [p for x in map(Path, paths) for p in (sorted(x.glob("*.ass")) if x.is_dir() else [x])]
    if not named:
        return []
    read = spark.read.format("binaryFile").load([str(p) for p in named]).select(F.regexp_replace("path", "^file:/*", "/").alias("path"), "content")
    told = []
    for r in reorder.collected(read).orderBy("path").toLocalIterator():
        if r["new_content"] is None:
            told.append((r["path"], 0, False, "no [Events] section"))
            continue
        if not dry_run and (r["changed"] or out):
            target = Path(out) / Path(r["path"]).name if out else Path(r["path"])
            target.parent.mkdir(parents=True, exist_ok=True)
            target.write_bytes(bytes(r["new_content"]))
        told.append((r["path"], r["n_top"], r["changed"], ""))
    return told
