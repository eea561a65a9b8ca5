"""Queries on the operators of this subpackage, with the SQL they are checked against where SQL can express them."""

from __future__ import annotations

from eventlake.llm import canonical, matching, packing, reading, survivor, tokens, variants
from eventlake.session import table


def p2_found(spark, sf_dir):
    return canonical.meant_entries(*(table(spark, sf_dir, n) for n in ("gap_entry", "change_entry", "artist_roster", "city_reference")))


def p4_found(spark, sf_dir):
    return survivor.surviving_artists(table(spark, sf_dir, "artist_lookup"), table(spark, sf_dir, "lookup_provider"))


def p4_truths(spark, sf_dir):
    """Every value of a field that the quality model judges true."""
    return survivor.true_values(survivor.lookup_claims(table(spark, sf_dir, "artist_lookup")), table(spark, sf_dir, "lookup_provider"))


def p4_sources(spark, sf_dir):
    """Sensitivity and specificity of each provider and field."""
    return survivor.quality_table(survivor.lookup_claims(table(spark, sf_dir, "artist_lookup")), table(spark, sf_dir, "lookup_provider"))


def _matches(spark, sf_dir):
    return matching.matches(*(table(spark, sf_dir, n) for n in ("change_entry", "raw_listing", "city_reference")))


def p5_found(spark, sf_dir):
    return _matches(spark, sf_dir).select("entry_id", "listing_id")


def p5_confidence(spark, sf_dir):
    """The matches with the rule that found them and their confidence."""
    return _matches(spark, sf_dir)


def p7_found(spark, sf_dir):
    return variants.same_act_pairs(table(spark, sf_dir, "artist_catalog"), table(spark, sf_dir, "gap_entry"))


def p7_groups(spark, sf_dir):
    """Each row's group by its least id, with the rows and links of the group: the pairs of p7_found without writing them out."""
    return variants.same_act_groups(table(spark, sf_dir, "artist_catalog"), table(spark, sf_dir, "gap_entry"))


def p8_ids(spark, sf_dir):
    return tokens.encode(table(spark, sf_dir, "documents"))


def p9_containers(spark, sf_dir):
    """Each document's pieces, their tokens and containers."""
    return packing.pack(tokens.token_counts(table(spark, sf_dir, "documents")))


def p10_found(spark, sf_dir):
    return reading.reading_levels(table(spark, sf_dir, "documents"), table(spark, sf_dir, "reading_label"))


QUERIES = {f.__name__: f for f in (p2_found, p4_found, p4_truths, p4_sources, p5_found, p5_confidence, p7_found, p7_groups, p8_ids, p9_containers, p10_found)}

_HOSTS = {"spotify": r"open\.spotify\.(?:example|com)", "instagram": r"instagram\.(?:example|com)", "facebook": r"facebook\.(?:example|com)", "youtube": r"youtube\.(?:example|com)", "telegram": r"(?:t-me\.example|telegram\.example|t\.me)", "vk": r"vk\.(?:example|com)"}
_PATHS = {"spotify": "(?:intl-[a-z]{2}/)?artist/", "youtube": "(?:c/|channel/|user/)?"}
_ACCOUNTS = "\n".join(
    rf"UNION ALL SELECT *, '{n}' AS field_name, nullif(lower(regexp_extract(trim(socials.{n}), '(?i)^https?://(?:www\.|m\.)?{h}/{_PATHS.get(n, '')}@?([^/?#@\s]+)/?(?:[?#]\S*)?$', 1)), '') AS field_value FROM r" for n, h in _HOSTS.items()
)
SQL = {
    "p4_found": rf"""
WITH r AS (SELECT nullif(replace(lower(trim(slug)), '_', '-'), '') AS s, provider, website, mbid, socials, fetched_at, coalesce(trust, -1) AS trust FROM artist_lookup LEFT JOIN lookup_provider USING (provider) WHERE ok),
h AS (SELECT *, regexp_replace(lower(regexp_extract(trim(website), '(?i)^https?://([a-z0-9-]+(?:\.[a-z0-9-]+)+)(?::\d+)?(?:[/?#]\S*)?$', 1)), '^www\.', '') AS host FROM r),
v AS (SELECT * EXCLUDE (host), 'website' AS field_name, CASE WHEN host LIKE '%.%' AND NOT regexp_matches(host, '(^|\.)(spotify|instagram|facebook|youtube|t-me|telegram|vk)\.(example|com|me|org)$') THEN host END AS field_value FROM h
UNION ALL SELECT *, 'mbid', CASE WHEN regexp_matches(lower(trim(mbid)), '^[0-9a-f]{{8}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{12}}$') AND regexp_matches(lower(mbid), '[1-9a-f]') THEN lower(trim(mbid)) END FROM r
{_ACCOUNTS})
SELECT s AS slug, field_name, field_value FROM (SELECT *, row_number() OVER (PARTITION BY s, field_name ORDER BY trust DESC, provider DESC, fetched_at DESC NULLS LAST, field_value DESC) AS rn FROM v WHERE s IS NOT NULL AND field_value IS NOT NULL) WHERE rn = 1""",
}
