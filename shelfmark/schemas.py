"""Fixed schemas of the catalog. Identity is the ``id`` column, never whole-row equality."""

from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DoubleType, LongType, StringType, StructField, StructType, TimestampType,
)

_TEXT, _LONG, _REAL, _FLAG, _TIME = StringType(), LongType(), DoubleType(), BooleanType(), TimestampType()
_TEXTS = ArrayType(_TEXT)


def _struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


def _array(**fields: DataType) -> ArrayType:
    return ArrayType(_struct(**fields))


REPOSITORY = _struct(
    id=_TEXT, platform=_TEXT, owner=_TEXT, name=_TEXT, url=_TEXT, description=_TEXT,
    stars=_LONG, forks=_LONG, issues=_LONG, language=_TEXT, topics=_TEXTS, license=_TEXT, archived=_FLAG,
    created_at=_TIME, updated_at=_TIME, pushed_at=_TIME, collected_at=_TIME,
    awesome=_struct(is_awesome_list=_FLAG, categories=_TEXTS, package_names=_TEXTS),
    sources=_array(repository=_TEXT, section=_TEXT),
    activity=_struct(
        last_commit=_TIME, commits_30d=_LONG, releases_90d=_LONG, contributors_90d=_LONG,
        last_push_days=_LONG, release_days=_LONG),
    score=_struct(
        overall=_REAL, popularity=_REAL, activity=_REAL, maintenance=_REAL, community=_REAL,
        documentation=_REAL, license=_REAL, security=_REAL, awesome_quality=_REAL),
    health=_struct(status=_TEXT, last_commit_days=_LONG, release_days=_LONG, contributors_90d=_LONG),
)

FLAT_COLUMNS = [
    "id", "owner", "name", "url", "description", "stars", "forks", "language", "license",
    "archived", "created_at", "updated_at", "pushed_at", "collected_at",
    "health_status", "score_overall",
]

FINDING = _struct(
    source=_TEXT, advisory_id=_TEXT, package=_TEXT, ecosystem=_TEXT, severity=_TEXT, summary=_TEXT,
    url=_TEXT, cve_ids=_TEXTS, repository_id=_TEXT, observed_at=_TIME)

DOCUMENT = _struct(
    repository_id=_TEXT, kind=_TEXT, path=_TEXT, url=_TEXT, content=_TEXT, bytes=_LONG, truncated=_FLAG)

SEARCH_HIT = _struct(
    seq=_LONG, source=_TEXT, query=_TEXT,
    repository=_struct(
        name=_TEXT, owner=_struct(login=_TEXT), html_url=_TEXT, description=_TEXT, stargazers_count=_LONG,
        forks_count=_LONG, forks=_LONG, open_issues_count=_LONG, language=_TEXT, topics=_TEXTS,
        license=_struct(key=_TEXT), archived=_FLAG, created_at=_TIME, updated_at=_TIME, pushed_at=_TIME))

OSV_RESPONSE = _struct(
    seq=_LONG, package=_TEXT, ecosystem=_TEXT,
    vulns=_array(
        id=_TEXT, summary=_TEXT, severity=_array(type=_TEXT, score=_TEXT), aliases=_TEXTS,
        database_specific=_struct(severity=_TEXT)))

KEV_FEED = _struct(vulnerabilities=_array(
    cveID=_TEXT, vendorProject=_TEXT, product=_TEXT, vulnerabilityName=_TEXT, dateAdded=_TEXT))

CVE_ENTRY = _struct(seq=_LONG, package=_TEXT, id=_TEXT, summary=_TEXT, cvss=_array(score=_TEXT))

REPOSITORY_FILE = _struct(
    repository_id=_TEXT, listing=_TEXT, file_order=_LONG, type=_TEXT, name=_TEXT, path=_TEXT,
    html_url=_TEXT, content_base64=_TEXT)
