"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only."""

from __future__ import annotations

import re
import string

from pyspark.sql import Column, DataFrame, functions as F

from aerolith.llm.common import let, running_sums, saved


def either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


# The three kinds, in their order, with the group that holds the
# value and the smallest length. Runs of hexadecimal digits are whole either
# way, so that the smallest length can stand in the pattern; an access key's
# shorter matches cannot hide a longer one either.
KEYWORDS = "|".join(map(either_case, ("password", "passwd", "secret", "token", "api_?key")))
ASSIGN = rf"""({KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
KINDS = (("assign", ASSIGN, 2, 6), ("access", ACCESS, 0, 20), ("hex", HEX, 0, 24))


def _alternatives(each: str) -> str:
    """``each`` for every character a value may hold (no back reference, which SQL engines lack)."""
    return "|".join(re.escape(c) + each for c in string.ascii_lowercase + string.digits + "+/_.=-")


# Values that are placeholders as a whole, or hold a long run of one character: never live, whatever the counts say.
FILLER = "my|your|the|an?|this|is|some|test|password|passwd|secret|token|api|key|access|value|here|insert|enter"
PLACEHOLDER = (
    rf"(?i)^(?:(?:{FILLER})[-_./+=]*)*(?:example|sample|change[-_.]?me|placeholder|your|dummy)(?:[-_./+=]*(?:{FILLER}))*[-_./+=]*[0-9]{{0,4}}$"
    rf"|^0?123456(?:7(?:8(?:90?)?)?)?$|^(?:{_alternatives('+')})$|(?:{_alternatives('{12}')})|(?-i:EXAMPLE(?:KEY)?$)"
)


def _matches(text: Column, kind: int) -> Column:
    """Array of (start, kind_no, end, value) of one kind, in code points.

    Texts between the matches give the positions: running sums, by blocks so
    that very many matches in one text stay cheap.
    """
    _, pattern, group, least = KINDS[kind]
    pat = F.lit(pattern)
    whole = F.regexp_extract_all(text, pat, F.lit(0))
    value = F.regexp_extract_all(text, pat, F.lit(group)) if group else whole
    rows = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
        F.transform(whole, F.length).alias("size"),
        value.alias("value"),
    )
    rows = F.filter(rows, lambda r: r["size"].isNotNull())  # the text after the last match

    def placed(r: Column) -> Column:
        before = running_sums(F.transform(r, lambda x: x["gap"] + x["size"]))

        def one(row: Column, at: Column) -> Column:
            start = (at + row["gap"]).cast("int")
            return F.struct(start.alias("start"), F.lit(kind).alias("kind_no"), (start + row["size"]).alias("end"), row["value"].alias("value"))

        return F.zip_with(r, before, one)

    spans = F.filter(let(rows, placed), lambda s: F.length(s["value"]) >= least)
    return F.when(text.rlike(pattern), spans)


SPAN = "array<struct<start:int,kind_no:int,end:int,value:string>>"


def secret_spans(text: Column) -> Column:
    """All matches of the three kinds by start, then kind; empty for null."""
    none = F.array().cast(SPAN)
    found = [F.coalesce(_matches(text, k).cast(SPAN), none) for k in range(len(KINDS))]
    return F.array_sort(F.concat(*found))


def any_secret(text: Column) -> Column:
    return F.coalesce(text.rlike(ASSIGN) | text.rlike(ACCESS) | text.rlike(HEX), F.lit(False))


def _written(spans: Column) -> Column:
    kind = F.array(*[F.lit(k[0]) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kind, s["kind_no"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def _candidates(scanned: DataFrame) -> DataFrame:
    return scanned.select("text_key", "owner", "repository", F.explode("found").alias("s")).select(
        "text_key", "owner", "repository", F.col("s.kind_no").alias("kind_no"), F.col("s.start").alias("start"),
        F.col("s.value").alias("value"), F.sha2(F.col("s.value"), 256).alias("hash"),
    )


def ownership(candidates: DataFrame, max_owners: int, max_repositories: int) -> DataFrame:
    """(hash, n_repositories, n_owners, most_repositories, widespread, live): ownership frequency decides.

    Repositories are counted per owner, where copies of one text count once,
    as that of the first repository, then owners: a value found everywhere is
    reduced before it is gathered. ``widespread``: more than ``max_owners``
    owners, or one with more than ``max_repositories`` repositories. ``live``:
    not widespread, and not a placeholder as a whole.
    """
    looks = ~F.col("value").rlike(PLACEHOLDER)
    texts = candidates.groupBy("hash", "owner", "text_key").agg(F.min("repository").alias("repository"), F.max(looks).alias("looks"))
    each = texts.groupBy("hash", "owner", "repository").agg(F.max("looks").alias("looks"))
    per_owner = each.groupBy("hash", "owner").agg(F.count("repository").alias("n"), F.max("looks").alias("looks"))
    spread = per_owner.groupBy("hash").agg(
        F.sum("n").alias("n_repositories"), F.count("owner").alias("n_owners"), F.max("n").alias("most_repositories"), F.max("looks").alias("looks")
    )
    widespread = (F.col("n_owners") > max_owners) | (F.col("most_repositories") > max_repositories)
    return spread.select("hash", "n_repositories", "n_owners", "most_repositories", widespread.alias("widespread"), (F.col("looks") & ~widespread).alias("live"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repository_col: str = "doc_id") -> DataFrame:
    """(doc_id, owner, repository, text_key, found) of every document."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(owner_col).alias("owner"), F.col(repository_col).cast("string").alias("repository"),
        F.sha2(text, 256).alias("text_key"), secret_spans(text).alias("found"),
    )


def find_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repository_col: str = "doc_id",
    max_owners: int = 2,
    max_repositories: int = 10,
) -> DataFrame:
    """Secrets of each document, and which of them look live by the owners and repositories that hold them.

    (doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live,
    n_widespread, most_owners, most_repositories, n_repositories). Offsets are
    code points, end exclusive. This method classifies the base spans and adds
    none: ``spans`` lists the base spans; :func:`ownership` says how many of
    them hold a live-looking (``n_live``) or a widely copied value
    (``n_widespread``). The last three are the document's largest counts of
    owners, of one owner's repositories, and of all repositories of a value.
    Masking (:func:`redact_live`) goes by the same rule. Null text counts as
    empty, null owners and repositories are not counted. Repeated rows come
    out as often as they go in. Other columns are ignored.
    """
    scanned = saved(scan(docs, id_col, text_col, owner_col, repository_col), "secrets")
    candidates = _candidates(scanned)
    found = candidates.select("text_key", "kind_no", "start", "hash").distinct().join(ownership(candidates, max_owners, max_repositories), "hash")
    per_text = found.groupBy("text_key").agg(
        F.sum(F.col("live").cast("long")).alias("n_live"),
        F.sum(F.col("widespread").cast("long")).alias("n_widespread"),
        *[F.max(c).alias(c) for c in ("n_owners", "most_repositories", "n_repositories")],
    )
    per_text = per_text.select("text_key", "n_live", "n_widespread", F.col("n_owners").alias("most_owners"), "most_repositories", "n_repositories")
    joined = scanned.join(per_text, "text_key", "left")
    count = [
        F.size(F.filter("found", lambda s: s["kind_no"] == k)).cast("long").alias(f"n_{name}") for k, (name, *_) in enumerate(KINDS)
    ]
    written = _written(F.col("found"))
    return joined.select(
        "doc_id", *count, F.sha2(written, 256).alias("base_sha256"), written.alias("spans"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_live", "n_widespread", "most_owners", "most_repositories", "n_repositories")],
    )


def redact_live(
    docs: DataFrame,
    text_col: str = "text",
    owner_col: str = "source",
    repository_col: str = "doc_id",
    max_owners: int = 2,
    max_repositories: int = 10,
    mask: str = "[SECRET]",
) -> DataFrame:
    """``docs`` with every occurrence of its own live-looking values replaced by ``mask``.

    :func:`ownership` decides, by owners and by repositories of an owner.
    All rows stay; texts without a candidate are passed on as they are and
    never shuffled. Widely copied examples stay. A value of letters only is
    masked where it is a whole word.
    """
    has = any_secret(F.col(text_col))
    some = docs.where(has)
    candidates = _candidates(saved(scan(some, repository_col, text_col, owner_col, repository_col), "secrets"))
    live = candidates.select("text_key", "hash", "value").distinct().join(ownership(candidates, max_owners, max_repositories).where("live"), "hash")
    longest = F.transform(F.reverse(F.array_sort(F.collect_list(F.struct(F.length("value"), "value")))), lambda s: s["value"])
    values = live.groupBy("text_key").agg(longest.alias("values"))
    name, key = "_secret_values", "_secret_text_key"
    joined = some.withColumn(key, F.sha2(F.col(text_col), 256)).join(values.select(F.col("text_key").alias(key), F.col("values").alias(name)), key, "left")

    def one(t: Column, v: Column) -> Column:
        word = F.regexp_replace(t, F.concat(F.lit("(?<![A-Za-z])"), v, F.lit("(?![A-Za-z])")), F.lit(re.sub(r"([\\$])", r"\\\1", mask)))
        return F.when(v.rlike("^[A-Za-z]+$"), word).otherwise(F.replace(t, v, F.lit(mask)))

    masked = F.aggregate(F.coalesce(name, F.array().cast("array<string>")), F.col(text_col), one)
    return joined.withColumn(text_col, masked).select(docs.columns).unionByName(docs.where(~has))


# --- the same in DuckDB ---------------------------------------------------------


def oracle(max_owners: int = 2, max_repositories: int = 10) -> str:
    """DuckDB SQL of :func:`find_secrets` over ``documents``."""
    one = """
      SELECT doc_id, source, k, {k} AS kind_no, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS i, m, v, gap FROM (
        SELECT doc_id, source, k, unnest(generate_series(1, len(w))) AS i, unnest(w) AS m, unnest(v) AS v, unnest(g[:len(w)]) AS gap FROM (
          SELECT doc_id, source, k, regexp_extract_all(t, $re${p}$re$) AS w, regexp_extract_all(t, $re${p}$re$, {g}) AS v,
                 string_split_regex(t, $re${p}$re$) AS g FROM texts)) """
    union = " UNION ALL ".join(one.format(k=k, p=p, g=g) for k, (_, p, g, _) in enumerate(KINDS))
    least = " ".join(f"WHEN {k} THEN {n}" for k, (*_, n) in enumerate(KINDS))
    name = " ".join(f"WHEN {k} THEN '{n}'" for k, (n, *_) in enumerate(KINDS))
    # fmt: off
    return f"""
    WITH texts AS (SELECT doc_id, source, coalesce(text, '') AS t, sha256(coalesce(text, '')) AS k FROM documents),
    matched AS ({union}),
    placed AS (
      SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, kind_no ORDER BY i) AS stop FROM matched),
    spans AS (
      SELECT doc_id, source, k, kind_no, CASE kind_no {name} END AS kind, stop - length(m) AS start, stop, v FROM placed
      WHERE length(v) >= CASE kind_no {least} END),
    per_text AS (
      SELECT v, source, k, min(doc_id::VARCHAR) AS repository, bool_or(NOT regexp_matches(v, $re${PLACEHOLDER}$re$)) AS looks FROM spans GROUP BY v, source, k),
    per_owner AS (
      SELECT v, source, count(DISTINCT repository) AS n, bool_or(looks) AS looks FROM per_text GROUP BY v, source),
    spread AS (
      SELECT v, sum(n) AS n_repositories, count(source) AS n_owners, max(n) AS most_repositories, bool_or(looks) AS looks,
             count(source) > {max_owners} OR max(n) > {max_repositories} AS widespread
      FROM per_owner GROUP BY v),
    each_doc AS (
      SELECT doc_id, count(*) FILTER (kind_no = 0) AS n_assign, count(*) FILTER (kind_no = 1) AS n_access,
             count(*) FILTER (kind_no = 2) AS n_hex,
             string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, kind_no) AS spans,
             count(*) FILTER (looks AND NOT widespread) AS n_live, count(*) FILTER (widespread) AS n_widespread,
             max(n_owners) AS most_owners, max(most_repositories) AS most_repositories, max(n_repositories) AS n_repositories
      FROM spans JOIN spread USING (v) GROUP BY doc_id)
    SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
           coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans,
           coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_widespread, 0)::BIGINT AS n_widespread,
           coalesce(most_owners, 0)::BIGINT AS most_owners, coalesce(most_repositories, 0)::BIGINT AS most_repositories,
           coalesce(n_repositories, 0)::BIGINT AS n_repositories
    FROM documents LEFT JOIN each_doc USING (doc_id)"""
    # fmt: on
