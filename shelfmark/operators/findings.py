"""Security findings: three advisory feeds matched to records by package name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as K
from ..functions.text import is_set
from ..functions.urls import package_candidates, package_name
from .catalog import min_stars
from .keyed import first_per_key

KEY = ["source", "advisory_id", "package", "repository_id"]
_NO_IDS = "array<string>"


def package_owners(records: DataFrame, order: str = "seq") -> DataFrame:
    """``(package, repository_id)``: the first record that offers a package keeps it."""
    extra = "awesome.package_names" if "awesome" in records.columns else F.lit(None).cast(_NO_IDS)
    offered = records.select(
        "id", F.col(order).alias("__o"), F.explode(package_candidates("name", extra)).alias("package"))
    return offered.groupBy("package").agg(F.min_by("id", F.struct("__o", "id")).alias("repository_id"))


def _summary(c: Column) -> Column:
    return F.substring(F.coalesce(c, F.lit("")), 1, K.SUMMARY_LENGTH)


def osv_rows(responses: DataFrame, observed_at) -> DataFrame:
    """One finding per advisory of a package response."""
    rows = responses.select("seq", "package", "ecosystem", F.posexplode("vulns").alias("entry", "v"))
    scored = F.filter("v.severity", lambda s: is_set(s["score"]))
    severity = F.coalesce(F.get(scored, 0)["score"], F.col("v.database_specific.severity"), F.lit(""))
    cves = F.filter("v.aliases", lambda a: F.upper(a).startswith("CVE-"))
    rid = F.coalesce("v.id", F.lit(""))
    return rows.select(
        F.lit("osv").alias("source"), rid.alias("advisory_id"), "package",
        F.coalesce("ecosystem", F.lit("")).alias("ecosystem"), severity.alias("severity"),
        _summary(F.col("v.summary")).alias("summary"), F.concat(F.lit(K.OSV_URL), rid).alias("url"),
        F.coalesce(cves, F.array().cast(_NO_IDS)).alias("cve_ids"),
        F.lit(observed_at).cast("timestamp").alias("observed_at"), "seq", "entry",
        package_name("package").alias("match_key"))


def cve_rows(entries: DataFrame, observed_at) -> DataFrame:
    """Entries whose id starts with ``CVE-``; severity is the score of the first metric."""
    good = entries.filter(F.upper(F.coalesce("id", F.lit(""))).startswith("CVE-"))
    return good.select(
        F.lit("cve").alias("source"), F.col("id").alias("advisory_id"), "package", F.lit("").alias("ecosystem"),
        F.coalesce(F.get("cvss", F.lit(0))["score"], F.lit("")).alias("severity"),
        _summary(F.col("summary")).alias("summary"), F.concat(F.lit(K.CVE_URL), F.col("id")).alias("url"),
        F.array("id").alias("cve_ids"), F.lit(observed_at).cast("timestamp").alias("observed_at"), "seq",
        F.lit(0).alias("entry"), package_name("package").alias("match_key"))


def kev_entries(feed: DataFrame) -> DataFrame:
    """Entries of the exploited-vulnerabilities feed with normalized product and vendor."""
    rows = feed.select("*", F.posexplode("vulnerabilities").alias("entry", "e"))
    seq = F.col("seq") if "seq" in feed.columns else F.lit(0).cast("bigint")
    return rows.select(
        seq.alias("seq"), "entry", "e.*", package_name("e.product").alias("product_key"),
        package_name("e.vendorProject").alias("vendor_key"))


def kev_matches(entries: DataFrame, owners: DataFrame) -> DataFrame:
    """Entries whose product or vendor is a wanted package, with the linked record.

    Packages are unique in ``owners``, so two equi joins neither multiply rows nor need an OR join.
    """
    product = owners.select(F.col("package").alias("product_key"), F.col("repository_id").alias("by_product"))
    vendor = owners.select(F.col("package").alias("vendor_key"), F.col("repository_id").alias("by_vendor"))
    joined = entries.join(product, "product_key", "left").join(vendor, "vendor_key", "left")
    matched = joined.filter("by_product is not null or by_vendor is not null")
    named = F.col("product_key") != ""
    return matched.withColumns({
        "package": F.when(named, F.col("product_key")).otherwise(F.col("vendor_key")),
        "repository_id": F.when(named, F.col("by_product")).otherwise(F.col("by_vendor")),
    }).drop("by_product", "by_vendor")


def kev_rows(matches: DataFrame, observed_at) -> DataFrame:
    has_id = is_set("cveID")
    return matches.select(
        F.lit("cisa-kev").alias("source"),
        F.when(has_id, F.col("cveID")).otherwise(F.coalesce("dateAdded", F.lit("unknown"))).alias("advisory_id"),
        "package", F.lit("").alias("ecosystem"), F.lit("KNOWN_EXPLOITED").alias("severity"),
        _summary(F.col("vulnerabilityName")).alias("summary"), F.lit(K.KEV_URL).alias("url"),
        F.when(has_id, F.array("cveID")).otherwise(F.array().cast(_NO_IDS)).alias("cve_ids"),
        F.lit(observed_at).cast("timestamp").alias("observed_at"), "seq", "entry", "repository_id")


def link(rows: DataFrame, owners: DataFrame) -> DataFrame:
    """Keep findings of wanted packages and name their record."""
    wanted = owners.withColumnRenamed("package", "match_key")
    return rows.join(wanted, "match_key").drop("match_key")


def link_optional(rows: DataFrame, owners: DataFrame) -> DataFrame:
    """Name the record where the package is wanted, else keep the finding's own one."""
    wanted = owners.select(F.col("package").alias("match_key"), F.col("repository_id").alias("__rid"))
    own = F.col("repository_id") if "repository_id" in rows.columns else F.lit(None).cast("string")
    return rows.join(wanted, "match_key", "left").withColumn(
        "repository_id", F.coalesce(F.col("__rid"), own)).drop("__rid", "match_key")


def dedupe(rows: DataFrame) -> DataFrame:
    return first_per_key(rows, KEY, [F.asc("seq"), F.asc("entry")])


def enrich(records: DataFrame, osv: DataFrame | None, kev: DataFrame | None, cve: DataFrame | None,
           observed_at, least_stars: int = 0, order: str = "seq", owners: DataFrame | None = None) -> DataFrame:
    """Findings of all given feeds, linked and de-duplicated. A feed that is None is skipped.

    ``owners`` may hold the packages of the records, where they were computed before.
    """
    if owners is None:
        owners = package_owners(min_stars(records, least_stars), order)
    parts = []
    if osv is not None:
        parts.append(link(osv_rows(osv, observed_at), owners))
    if kev is not None:
        parts.append(kev_rows(kev_matches(kev_entries(kev), owners), observed_at))
    if cve is not None:
        parts.append(link(cve_rows(cve, observed_at), owners))
    if not parts:
        raise ValueError("no feed given")
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return dedupe(rows)


def report(records: DataFrame, found: DataFrame, errors: DataFrame | None = None,
           least_stars: int = 0, order: str = "seq", owners: DataFrame | None = None) -> DataFrame:
    eligible = min_stars(records, least_stars)
    return found.agg(F.count("*").alias("finding_count")).select(
        "finding_count", eligible.agg(F.count("*")).scalar().alias("repositories_scanned"),
        (package_owners(eligible, order) if owners is None else owners).agg(F.count("*")).scalar().alias("packages_queried"),
        (errors.agg(F.count("*")).scalar() if errors is not None else F.lit(0)).cast("bigint").alias("error_count"))


def stored(findings: DataFrame, repository_id: str | None = None) -> DataFrame:
    """Stored findings with ``cve_ids`` decoded from JSON text (bad text -> [])."""
    decoded = findings
    if dict(findings.dtypes)["cve_ids"] == "string":
        decoded = findings.withColumn("cve_ids", F.coalesce(
            F.from_json("cve_ids", _NO_IDS), F.array().cast(_NO_IDS)))
    if repository_id:
        return decoded.filter(F.col("repository_id") == repository_id)
    return decoded.orderBy("source", "advisory_id")
