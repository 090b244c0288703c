"""Secret scans with an incremental ledger of blobs.

Every version of every path is addressed by the SHA-256 of its content. The ledger holds, for each blob and rule
version that was ever scanned, the spans found (also when there are none). A run scans only the pairs that the ledger
lacks, and joins findings back to all paths and versions of the content.

At scale: what goes through the joins is a digest and the columns that the caller carries, never a text beside them; texts of unseen
contents are shuffled once, by digest, equal ones merged before, and a run over a history that has been scanned reads no text a
second time. A digest that many paths share is a large side of a join, which Spark splits. The ledger is a table in the folder the
caller names; each run appends what is new, so a run that dies half-way leaves at most rows that the next one finds done. Rule
versions are digests of the rules themselves.

Cases: a null text is empty; empty texts have no spans; null paths are kept; repeated rows are judged alike, each with
its row; an empty table gives an empty result; text of any length is scanned as a whole.
"""

import hashlib
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.shared import packed, shared_folder, store, store_path, table, whole_text

# The base patterns and least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a maximal run, as [0-9a-f]+ with shorter matches dropped
LEAST_ASSIGNED, LEAST_ACCESS = 12, 18
NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")
BASE = ("assign", "access", "hex")
# Further kinds, whose spans come beside the base ones.
MORE = {
    "jwt": ("eyJ", re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
    "pem": ("-----BEGIN ", re.compile(r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----")),
    "forge": ("gh", re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}")),
}
KINDS = (*BASE, *MORE)
#: The version of the rules: another pattern or bound makes another one.
RULES = hashlib.sha256(repr((ASSIGN.pattern, ASSIGN.flags, ACCESS.pattern, HEX.pattern, LEAST_ASSIGNED, LEAST_ACCESS, NAMES,
                             [(k, m, p.pattern, p.flags) for k, (m, p) in MORE.items()])).encode()).hexdigest()[:16]
LEDGER = "blob string, rules string, spans array<struct<kind: string, start: bigint, end: bigint>>"


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """All spans by start, then kind; code points, end exclusive."""
    found = []
    low = text.lower() if text.isascii() else text.encode().lower().decode()
    if any(name in low for name in NAMES):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    for kind, (mark, pattern) in MORE.items():
        if mark in text:
            found += [(kind, *m.span()) for m in pattern.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def scanned(blobs: DataFrame, rules: str) -> DataFrame:
    """Ledger rows of `blob`, `text`."""

    def scan(frames):
        for frame in frames:
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in spans_of(t)] for t in frame["text"]]
            yield pd.DataFrame({"blob": frame["blob"], "rules": rules, "spans": spans})

    return blobs.select("blob", "text").mapInPandas(scan, LEDGER)


def digest_of(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def scan_versions(
    versions: DataFrame, ledger: str | None = None, text: str = "text", rules: str = RULES, carry: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """All versions (`row` with all columns, or those in `carry`; `blob`, `spans`), and the ledger rows this run added.

    `ledger` is the folder of the ledger table, made by the first run; None is a new one.
    """
    spark = versions.sparkSession
    ledger = ledger or store_path(spark, "secret-ledger")
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(ledger)
    done = lambda: spark.read.schema(LEDGER).parquet(ledger).where(F.col("rules") == rules)
    row = packed(versions if carry is None else versions.select(*carry))
    addressed = store(versions.select(row, digest_of(whole_text(text)).alias("blob")), "secret-versions")
    unseen = store(addressed.select("blob").distinct().join(done().select("blob"), "blob", "left_anti"), "secret-unseen")
    new = spark.createDataFrame([], LEDGER)
    if not unseen.isEmpty():
        texts = versions.select(whole_text(text).alias("text")).withColumn("blob", digest_of(F.col("text")))
        blobs = texts.join(unseen, "blob", "left_semi").dropDuplicates(["blob"])
        new = store(scanned(blobs, rules), "secret-new")
        new.write.mode("append").parquet(ledger)
    found = done().where(F.size("spans") > 0).select("blob", "spans").dropDuplicates(["blob"])
    none = F.array().cast("array<struct<kind: string, start: bigint, end: bigint>>")
    return addressed.join(found, "blob", "left").select("row", "blob", F.coalesce("spans", none).alias("spans")), new


def ledger_of(spark: SparkSession, path: str) -> str:
    """The folder of a table's ledger in the shared folder, the same in every run."""
    return f"{shared_folder(spark)}/llm-secret-ledger-{hashlib.sha256(path.encode()).hexdigest()[:16]}"


def joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    versions, _ = scan_versions(documents, ledger_of(spark, f"{sf_dir}/documents.parquet"), carry=["doc_id"])
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return versions.select(
        F.col("row.doc_id").alias("doc_id"), *[count(k) for k in BASE],
        F.sha2(F.encode(joined(base), "UTF-8"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )


def digest(text: str | None) -> dict:
    """The same digest of one text, for tests and single files."""
    spans = spans_of(text or "")
    line = lambda kinds: ",".join(f"{k}:{a}:{b}" for k, a, b in spans if k in kinds)
    return {"base_sha256": hashlib.sha256(line(BASE).encode()).hexdigest(), "spans": line(KINDS)}
