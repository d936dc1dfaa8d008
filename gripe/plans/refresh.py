"""The periodic report as an incremental job (T8): a run reads the days of the store that are new.

The count tables of the report (TF-IDF terms, cloud words, word pairs, volumes,
risk groups) are sums over complaints, so each day's share is kept as a partial
table and a report adds them up.  Only the first copy of a text counts, over all
days: the texts counted so far are in a key index, which is asked for the texts of
the new days.

State folder: ``manifest-N`` (the highest N is valid) names for each day the
files it was computed from and the run whose partial tables hold it; ``runs/``
has the partial tables; ``texts`` is the index.  A run writes the index entries
(not visible yet), the partial tables, then the manifest, which is the moment
of success, then makes the entries visible; the next run settles what a failure
left.  A day whose files changed, or that appears late, is computed again
together with all days after it, since texts may now have another first copy.
The topic and churn models are not sums; the full job (:mod:`analysis`) fits them.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import lexicons as L
from .. import schemas
from ..operators import churn as CH
from ..operators import dedup as DD
from ..operators import report as RP
from ..operators import terms as TM
from ..operators.key_index import KeyIndex
from ..operators.sinks import PART, write_report
from ..session import list_names, path_exists, read_text, remove, write_text

#: Partial tables: grouping columns and the count that is added up.
PARTIALS = {
    "terms": (["company", "term"], "tf"),
    "words": (["company", "word"], "n"),
    "pairs": (["bigram"], "n"),
    "risk": (["company", "risk_group"], "n"),
}


def store_days(spark: SparkSession, store: str) -> dict[str, str]:
    """Each part of the store with a digest of its files' names and lengths (metadata only)."""
    out = {}
    for name, _ in list_names(spark, store):
        if name.startswith(f"{PART}="):
            files = [f for f in list_names(spark, f"{store}/{name}") if not f[0].startswith(("_", "."))]
            out[name[len(PART) + 1:]] = hashlib.sha256(json.dumps(files).encode()).hexdigest()
    return out


def manifest(spark: SparkSession, state: str) -> dict:
    names = [n for n, _ in list_names(spark, state) if n.startswith("manifest-") and not n.endswith(".new")]
    if not names:
        return {"seq": 0, "days": {}, "lexicon": None}
    return json.loads(read_text(spark, f"{state}/{max(names)}"))


def _save(spark: SparkSession, state: str, m: dict) -> None:
    m["seq"] += 1
    write_text(spark, f"{state}/manifest-{m['seq']:09d}", json.dumps(m))
    for n, _ in list_names(spark, state):
        if n.startswith("manifest-") and n < f"manifest-{m['seq']:09d}":
            remove(spark, f"{state}/{n}")
    live = {d["run"] for d in m["days"].values()}
    for run, _ in list_names(spark, f"{state}/runs"):
        if run not in live:
            remove(spark, f"{state}/runs/{run}")


def _texts(spark: SparkSession, state: str, m: dict) -> KeyIndex:
    """The index of counted texts; entries of a run that the manifest does not know are forgotten."""
    index = KeyIndex(spark, f"{state}/texts")
    index.sweep()
    for run in index.pending():
        if run in {d["run"] for d in m["days"].values()} and path_exists(spark, f"{index.path}/{run}/SHAPE"):
            index.commit(run)
        else:
            remove(spark, f"{index.path}/{run}")
    return index


def _lexicon_id(lexicon: L.Lexicon) -> str:
    return hashlib.sha256(repr(lexicon).encode()).hexdigest()


def _partials(rows: DataFrame, lexicon: L.Lexicon) -> dict[str, DataFrame]:
    return {
        "terms": TM.company_terms(rows, "cleaned", lexicon.analysis_stop, "company", "day"),
        "words": TM.company_words(rows, "cleaned", "company", "day"),
        "pairs": TM.bigram_counts(rows, "cleaned", "day"),
        "risk": CH.rule_risk_table(rows, lexicon).groupBy("day", "company", "risk_group").agg(F.count(F.lit(1)).alias("n")),
    }


def update(spark: SparkSession, store: str, state: str, lexicon: L.Lexicon = L.REFERENCE) -> list[str]:
    """Bring the state up to the store; returns the days that were read (none where nothing changed)."""
    m, days = manifest(spark, state), store_days(spark, store)
    if m["lexicon"] != _lexicon_id(lexicon):  # other word lists: nothing counted so far can be used
        m["days"] = {}
    index = _texts(spark, state, m)
    known = m["days"]
    changed = [d for d in {*days, *known} if days.get(d) != known.get(d, {}).get("files")]
    if not changed:
        return []
    first = min(changed)
    folded = [d for d, v in known.items() if v.get("folded")]
    if folded and first <= max(folded):  # their shares are one sum
        first = min(first, *folded)
    todo = sorted(d for d in days if d >= first)
    if index.exists() and index.runs():
        held = index.runs()
        if not known:
            for run in held:
                remove(spark, f"{index.path}/{run}")
        elif any(d >= first for d in known):  # texts whose first copy was in a day that is computed again
            index.merge(sorted(held), max(x["level"] for x in held.values()), F.col("part") < first)
    run = f"run-{uuid.uuid4().hex[:16]}"
    made = None
    if todo:
        fields = [f for f in schemas.STORE.fields if f.name != PART]
        rows = (spark.read.schema(T.StructType([*fields, T.StructField(PART, T.StringType())])).option("basePath", store)
                .parquet(*[f"{store}/{PART}={d}" for d in todo]).withColumnRenamed(PART, "day"))
        rows = DD.dedup_text(rows.select("day", "crawled_at", "link", "company", "cleaned", "sentiment"), "cleaned",
                             ["day", "crawled_at", "link"])
        rows = rows.withColumn("_key", DD.content_key("cleaned")).persist(StorageLevel.MEMORY_AND_DISK)
        texts = f"{state}/runs/{run}/texts"  # written once: five readers below
        index.unseen(rows, before=first).write.option("compression", "zstd").parquet(texts)
        rows.unpersist()
        new = spark.read.schema(rows.schema).parquet(texts)
        made = index.add(new.select("_key", F.col("day").alias("part")), run)
        for name, table in _partials(new, lexicon).items():
            # several days are brought together first, for few files each; the rows of one day are there already
            table = table if len(todo) == 1 else table.hint("rebalance", "day")
            table.write.partitionBy("day").parquet(f"{state}/runs/{run}/{name}")
        remove(spark, texts)
    m["days"] = {**{d: v for d, v in known.items() if d < first}, **{d: {"files": days[d], "run": run} for d in todo}}
    m["lexicon"] = _lexicon_id(lexicon)
    _save(spark, state, m)
    if made:
        index.commit(made)
        index.compact()
    return todo


def fold(spark: SparkSession, state: str, before: str) -> None:
    """Add up the partial tables of all days before ``before`` into those of the last of them."""
    m = manifest(spark, state)
    old = sorted(d for d in m["days"] if d < before)
    if len({m["days"][d]["run"] for d in old}) < 2:
        return
    run = f"run-{uuid.uuid4().hex[:16]}"
    for name, (keys, n) in PARTIALS.items():
        part = _read(spark, state, m, name, old)
        if part is not None:
            (part.groupBy(*keys).agg(F.sum(n).alias(n)).withColumn("day", F.lit(old[-1]))
             .write.partitionBy("day").parquet(f"{state}/runs/{run}/{name}"))
    for d in old:
        m["days"][d].update(run=run, folded=True)
    _save(spark, state, m)


def _read(spark: SparkSession, state: str, m: dict, name: str, days: list[str] | None = None) -> DataFrame | None:
    keys, n = PARTIALS[name]
    schema = ", ".join(f"{k} string" for k in keys) + f", {n} long"
    wanted = sorted({(v["run"], d) for d, v in m["days"].items() if days is None or d in days})
    paths = [f"{state}/runs/{run}/{name}/day={d}" for run, d in wanted]
    paths = [p for p in paths if path_exists(spark, p)]
    return spark.read.schema(schema).parquet(*paths) if paths else None


def tables(spark: SparkSession, state: str, lexicon: L.Lexicon = L.REFERENCE) -> dict[str, DataFrame]:
    """The report's count tables over all days of the state; nothing of the store is read."""
    m = manifest(spark, state)
    sums = {}
    for name, (keys, n) in PARTIALS.items():
        part = _read(spark, state, m, name)
        if part is None:
            return {}
        sums[name] = part.groupBy(*keys).agg(F.sum(n).alias(n))
    pairs = TM.vocabulary(sums["pairs"], 15, freq="n", term="bigram")
    edges = TM.word_edges(pairs)
    return {
        "tfidf_top5": TM.tfidf_from_counts(sums["terms"], 30, 5),
        "cloud_words": TM.cloud_from_counts(sums["words"], lexicon.analysis_stop, 60),
        "bigram_top15": pairs, "word_edges": edges, "word_nodes": TM.word_nodes(edges),
        "company_volume": RP.company_volume(sums["risk"], n="n"),
        "risk_heatmap": RP.crosstab_pct(sums["risk"], "company", "risk_group", L.RISK_LABELS,
                                        names=["low", "mid", "critical"], digits=2, n="n"),
        "risk_share": RP.share_of_total(RP.category_counts(sums["risk"], "risk_group", L.RISK_LABELS, n="n"), digits=2),
    }


def run_refresh(spark: SparkSession, store: str, state: str, out_dir: str, lexicon: L.Lexicon = L.REFERENCE,
                fmt: str = "parquet", fold_before: str | None = None) -> dict:
    """One periodic run: update the state, write every table.  Returns the days that were read."""
    read = update(spark, store, state, lexicon)
    if fold_before:
        fold(spark, state, fold_before)
    found = tables(spark, state, lexicon)
    write_report(found, out_dir, fmt)
    return {"days_read": read, "days": len(manifest(spark, state)["days"]), "tables": sorted(found)}


def main(argv: list[str] | None = None) -> None:
    import argparse

    from ..session import get_spark

    p = argparse.ArgumentParser(description="incremental complaint report")
    p.add_argument("--store", required=True, help="complaint store (stream output)")
    p.add_argument("--state", required=True, help="folder of the partial tables")
    p.add_argument("--out", required=True, help="output folder, one table per report section")
    p.add_argument("--lexicon", default="reference")
    p.add_argument("--format", default="parquet")
    p.add_argument("--fold-before", help="add up the partial tables of the days before this one, yyyy-MM-dd")
    a = p.parse_args(argv)
    lex = L.profile(a.lexicon) if a.lexicon in L.PROFILES else L.Lexicon.load(a.lexicon)
    print(json.dumps(run_refresh(get_spark("gripe-refresh"), a.store, a.state, a.out, lex, a.format, a.fold_before)))


if __name__ == "__main__":
    main()
