"""SQL twins of the domain views, put in front of a query's own SQL."""

from __future__ import annotations

from tastegrid.functions.ratings import REVIEW_LABELS
from tastegrid.sources.domain import LABEL_CUTS, URL_END, URL_START

_LABEL_CASE = " ".join(f"WHEN positive_ratio >= {cut} THEN '{name}'" for cut, name in LABEL_CUTS)
LABEL_VALUES = ", ".join(f"('{k}', {v})" for k, v in REVIEW_LABELS.items())


def draw(key: str, seed: int = 42) -> str:
    """The hash digest of a key."""
    return f"md5('{seed}:' || {key})"


def unit(digest: str) -> str:
    """A digest as a number in [0, 1)."""
    return f"(CAST('0x' || substr({digest}, 1, 8) AS BIGINT) / 4294967296.0::DOUBLE)"


def stars(u: str) -> str:
    """Rating drawn from the flag."""
    return (f"CASE WHEN is_recommended THEN CASE WHEN {u} < 0.3::DOUBLE THEN 4 ELSE 5 END "
            f"ELSE CASE WHEN {u} < 0.7::DOUBLE THEN 1 ELSE 2 END END")


VIEWS = {
    "reviews": """
        SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS review_id,
               l_orderkey AS order_id, l_partkey AS item_id, l_returnflag <> 'R' AS is_recommended,
               l_quantity AS hours, l_linenumber AS helpful, CAST(l_shipdate AS DATE) AS date
        FROM lineitem""",
    "interactions": """
        SELECT r.*, o_custkey AS user_id FROM reviews r JOIN orders ON o_orderkey = order_id""",
    "rated": f"""
        SELECT *, {stars(unit(draw('review_id')))} AS rank FROM interactions""",
    "ratings": """
        SELECT user_id, item_id, max(rank)::DOUBLE AS rating FROM rated GROUP BY ALL""",
    "item_facts": """
        SELECT item_id, min(date) AS date_release,
               round(avg(is_recommended::INT::DOUBLE) * 100.0::DOUBLE)::INT AS positive_ratio,
               count(*) AS user_reviews
        FROM reviews GROUP BY item_id""",
    "catalog": """
        SELECT p_partkey AS item_id, p_name AS title, p_type <> 'PROMO' AS win,
               p_size % 3 = 0 AS mac, p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') AS linux,
               p_size * 2.0::DOUBLE AS price_final, p_retailprice AS price_original,
               p_type = 'LARGE' AS handheld
        FROM part""",
    "games": f"""
        SELECT c.*, f.date_release, f.positive_ratio, f.user_reviews,
               CASE {_LABEL_CASE} END AS rating
        FROM catalog c LEFT JOIN item_facts f ON f.item_id = c.item_id""",
    "metadata": """
        SELECT p_partkey AS item_id, p_brand || ' ' || p_type AS description,
               string_split(p_name, ' ') AS tags
        FROM part""",
    "metadata_text": """
        SELECT item_id, description,
               CASE WHEN len(tags) = 0 THEN '[]'
                    ELSE '[''' || array_to_string(tags, ''', ''') || ''']' END AS tags
        FROM metadata""",
    "extra_facts": f"""
        SELECT '{URL_START}' || doc_id || '{URL_END}' AS url,
               (n_chars % 100)::INT AS metacritic, 'PC' AS platform,
               source AS tags,
               '[''' || lang || ''', ''sub ' || source || ''']' AS languages
        FROM documents""",
    # tags cleaned, one row per (item, tag)
    "item_tags": """
        SELECT item_id, unnest(string_split(regexp_replace(tags, '[ \\[\\]'']', '', 'g'), ',')) AS tag
        FROM metadata_text WHERE length(tags) <> 2""",
    # languages cleaned, one row per (item, language)
    "item_languages": """
        SELECT item_id, unnest(string_split(regexp_replace(languages, '[ \\[\\]'']', '', 'g'), ',')) AS language
        FROM (SELECT CAST(substr(url, 36, length(url) - 51) AS BIGINT) AS item_id, languages
              FROM extra_facts WHERE url IS NOT NULL AND tags IS NOT NULL AND languages IS NOT NULL)""",
}
NEEDS = {
    "reviews": [], "interactions": ["reviews"], "rated": ["interactions"], "ratings": ["rated"],
    "item_facts": ["reviews"], "catalog": [], "games": ["catalog", "item_facts"],
    "metadata": [], "metadata_text": ["metadata"], "extra_facts": [],
    "item_tags": ["metadata_text"], "item_languages": ["extra_facts"],
}


def _ordered(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(name: str) -> None:
        for need in NEEDS[name]:
            visit(need)
        if name not in out:
            out.append(name)
    for name in names:
        visit(name)
    return out


def over(views: str, body: str, **extra: str) -> str:
    """``body`` over the named views; ``extra`` adds further common tables in order."""
    parts = [(n, VIEWS[n]) for n in _ordered(views.split())] + list(extra.items())
    if not parts:
        return body
    ctes = ",\n".join(f"{name} AS ({text})" for name, text in parts)
    return f"WITH {ctes}\n{body}"
