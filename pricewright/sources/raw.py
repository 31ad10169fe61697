"""Raw nested documents: writing the embedded snapshot, reading branches, setting bad records aside."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import fixed_values as fv
from ..operators.quality import split_rejects
from ..schemas import RAW_DOCUMENT, fields


UNREADABLE = "_corrupt_record"
DOCUMENT_ORDER = "_document"


def embedded_document() -> dict:
    """The embedded snapshot in the shape of a raw document."""
    topup = {}
    for key, (game, publisher, currency, low, high, sources, tiers) in fv.TOPUP.items():
        field = fv.CURRENCY_FIELD[key]
        topup[key] = {
            "game": game,
            "publisher": publisher,
            "currency": currency,
            "sources": sources,
            "third_party_discount_pct_min": low,
            "third_party_discount_pct_max": high,
            "tiers": [{field: n, "bonus": b, "price_usd": p, "label": t} for n, b, p, t in tiers],
        }
    esports_fields = [
        "competition_tier", "competition_score", "prize_pool_2025_usd", "tournaments_total",
        "peak_viewers", "regional_leagues", "sources",
    ]
    segment_fields = [
        "threshold_monthly_usd", "player_share_pct_min", "player_share_pct_max",
        "revenue_share_pct_min", "revenue_share_pct_max",
    ]
    return {
        "topup": topup,
        "stats": fv.STATS,
        "esports": {key: dict(zip(esports_fields, row)) for key, row in fv.ESPORTS.items()},
        "market": {
            "global": fv.MARKET_GLOBAL,
            "spending_segments": {k: dict(zip(segment_fields, v)) for k, v in fv.MARKET_SEGMENTS.items()},
            "regional_price_index": {
                k: {"price_index": index, "countries": countries}
                for k, (index, countries) in fv.MARKET_REGIONS.items()
            },
        },
    }


def document_frame(spark: SparkSession, document: dict) -> DataFrame:
    """One raw document as a one-row frame in the raw schema."""
    def branch(entries: dict | None) -> dict | None:
        return None if entries is None else {k: json.dumps(v, ensure_ascii=False) for k, v in entries.items()}

    row = tuple(branch(document.get(field.name)) for field in fields(RAW_DOCUMENT))
    return spark.createDataFrame([row], RAW_DOCUMENT)


def write_raw(documents: DataFrame, path: str) -> None:
    """Raw documents as JSON text, one per line, branch entries as nested objects again."""
    # every entry value already is JSON text, so an object is its quoted keys and values put together
    parts = []
    for field in (f.name for f in fields(RAW_DOCUMENT) if f.name in documents.columns):
        entries = F.transform(
            F.map_entries(field),
            lambda e: F.concat(
                F.regexp_replace(F.to_json(F.array(e["key"])), r"^\[|\]$", ""), F.lit(":"), F.coalesce(e["value"], F.lit("null"))
            ),
        )
        text = F.concat(F.lit(f'"{field}":{{'), F.array_join(entries, ","), F.lit("}"))
        parts.append(F.when(F.col(field).isNotNull(), text))
    line = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    documents.select(line.alias("value")).write.mode("overwrite").text(path)


def read_raw(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Raw documents from a file or folder: one per line, or one per file when `multi_line`.

    What cannot be parsed is kept in `_corrupt_record`; `_document` orders the documents by file and place.
    """
    reader = spark.read.schema(f"{RAW_DOCUMENT}, {UNREADABLE} string").option("multiLine", multi_line)
    parsed = reader.option("columnNameOfCorruptRecord", UNREADABLE).json(path)
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    return parsed.select("*", place.alias(DOCUMENT_ORDER))


def unreadable_documents(documents: DataFrame) -> DataFrame:
    """(game_key, payload, reject_reason) of documents that could not be parsed; they belong to no game."""
    if UNREADABLE not in documents.columns:
        return documents.sparkSession.createDataFrame([], "game_key string, payload string, reject_reason string")
    # a branch is named because Spark does not read the unparsed text alone
    broken = documents.filter(F.col(UNREADABLE).isNotNull() & (F.coalesce(F.size("topup"), F.lit(0)) >= 0))
    return broken.select(F.lit(None).cast("string").alias("game_key"), F.col(UNREADABLE).alias("payload"), F.lit("unreadable").alias("reject_reason"))


def branch_records(documents: DataFrame, branch: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of one branch, one row per key with the fields of `schema`.

    Keys that start with an underscore describe the run and are no records; an `_error` entry in their
    place means the whole branch failed and is reported as a reject.  `_document` carries the order of the
    documents on, so that the first of several records is defined.
    """
    order = F.col(DOCUMENT_ORDER) if DOCUMENT_ORDER in documents.columns else F.lit(0)
    entries = documents.select(order.alias(DOCUMENT_ORDER), F.explode(branch).alias("game_key", "payload"))
    failed_branch = F.col("game_key") == "_error"
    entries = entries.filter(~F.col("game_key").startswith("_") | failed_branch)
    parsed = entries.withColumn("record", F.from_json("payload", schema))
    error = F.when(failed_branch, F.col("payload")).otherwise(F.col("record._error"))
    # an object without any known field, text that is no object, and null are all empty
    usable = F.when(~F.coalesce(F.trim("payload"), F.lit("")).isin("", "null", "{}"), F.col("record"))
    good, rejects = split_rejects(parsed, error, usable)
    kept = [f"record.{name}" for name in fields(schema).fieldNames() if name != "_error"]
    return good.select("game_key", DOCUMENT_ORDER, *kept), rejects.select("game_key", "payload", "reject_reason")


def key_list(spark: SparkSession, keys: list[str]) -> DataFrame:
    """(game_key, ordinal): the configured keys in their order."""
    return spark.createDataFrame(list(zip(keys, range(len(keys)))), "game_key string, ordinal int")


def configured_only(records: DataFrame, keys: DataFrame, keep_absent: bool = False) -> DataFrame:
    """Records of configured keys with their ordinal; optionally a row of NULLs for a key without record."""
    if keep_absent:
        return keys.join(records, "game_key", "left")
    return records.join(F.broadcast(keys), "game_key")  # the configured list, not data


def market_table(documents: DataFrame, group: str, key: str, schema: str) -> DataFrame:
    """One lookup of the market branch (`spending_segments`, `regional_price_index`) as rows."""
    text = documents.select(F.col("market").getItem(group).alias("_text"))
    entries = text.select(F.explode(F.from_json("_text", "map<string,string>")).alias(key, "_row"))
    return entries.withColumn("_row", F.from_json("_row", schema)).select(key, "_row.*")


def source_registry(spark: SparkSession, registry: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """(category, name, url) from the nested registry."""
    nested = spark.createDataFrame([(registry or fv.SOURCE_REGISTRY,)], "registry map<string,map<string,string>>")
    by_category = nested.select(F.explode("registry").alias("category", "_sources"))
    return by_category.select("category", F.explode("_sources").alias("name", "url"))


def source_counts(sources: DataFrame) -> DataFrame:
    return sources.groupBy("category").agg(F.count(F.lit(1)).alias("sources"))
