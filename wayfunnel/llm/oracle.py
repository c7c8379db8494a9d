"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from wayfunnel.llm.licences import TEMPLATES, needed_of, step_of

# As in mixing: md5 digits to a number in [0, 1), and the Poisson sums that it reaches.
MIXING = """
WITH sizes AS (
  SELECT source, sum(coalesce(strlen(text), 0)) AS n_bytes FROM documents GROUP BY source
), weights AS (
  SELECT source, n_bytes, sqrt(n_bytes::DOUBLE) AS weight FROM sizes
), totals AS (
  SELECT sum(n_bytes)::DOUBLE AS all_bytes,
         round(sum(round(weight, 6)::DECIMAL(38, 6))::DOUBLE, 6) AS all_weights
  FROM weights
), rates AS (
  SELECT source, CASE WHEN n_bytes > 0
    THEN least(weight / all_weights * all_bytes * 1.0 / n_bytes, 64.0) ELSE 1.0 END AS rate
  FROM weights, totals
), terms AS (
  SELECT source, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p
  FROM rates, generate_series(0, 185) AS s(k)
), steps AS (
  SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS reached FROM terms
), drawn AS (
  SELECT *, ('0x' || substr(md5('11:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT
            / 4503599627370496.0::DOUBLE AS u
  FROM documents
), counted AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, count(s.k) AS copies
  FROM drawn d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source AND s.reached <= d.u
  GROUP BY ALL
), copied AS (
  SELECT * EXCLUDE (copies), unnest(range(copies))::INTEGER AS copy FROM counted
)
SELECT *, ('0x' || substr(md5('12:' || coalesce(doc_id::VARCHAR, '') || ':' || copy::VARCHAR), 1, 13))::BIGINT
          / 4503599627370496.0::DOUBLE AS shuffle_key
FROM copied
"""


def _licence_templates() -> str:
    """(number, label, words, step, needed) of the templates."""
    rows = []
    for number, (label, text) in enumerate(TEMPLATES):
        words = ", ".join(f"'{w}'" for w in sorted(set(text.split())))
        rows.append(f"({number}, '{label}', [{words}], {step_of(text)}, {needed_of(text, 0.8)})")
    return ",\n         ".join(rows)


# Base phrases by word number; every template with every block of the texts that hold enough of its
# words, and of templates that match each other's words the better one in a block.
LICENCES = r"""
WITH lowered AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), worded AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM lowered
), phrases(label, p) AS (
  VALUES ('cc-by', ['cc', 'by']), ('gpl', ['general', 'public', 'license']),
         ('reserved', ['all', 'rights', 'reserved'])
), numbered AS (
  SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM worded
), places AS (
  SELECT r, i - 1 AS word, label
  FROM numbered JOIN phrases ON w[i] = p[1] AND w[i:i + len(p) - 1] = p
), base AS (
  SELECT r, count(*) AS n_base, min(word) AS first_word, max(word) AS last_word,
         list(DISTINCT label) AS labels
  FROM places GROUP BY r
), templates(number, label, words, step, needed) AS (
  VALUES TEMPLATES
), sets AS (
  SELECT r, w, list_distinct(w) AS held FROM worded
), candidates AS (
  SELECT r, w, number, label, words, step, needed
  FROM sets, templates WHERE len(list_intersect(words, held)) >= needed
), blocks AS (
  SELECT *, unnest(range(0, (len(w) + step - 1) // step)) AS block FROM candidates
), shares AS (
  SELECT r, number, label, words, step, needed, block,
         len(list_intersect(words, w[block * step + 1:block * step + 2 * step])) AS shared
  FROM blocks
), matches AS (
  SELECT *, shared::DOUBLE / len(words) AS share FROM shares WHERE shared >= needed
), kept AS (
  SELECT * FROM matches a WHERE NOT EXISTS (
    SELECT 1 FROM matches b
    WHERE b.r = a.r AND b.step = a.step AND b.block = a.block AND b.number <> a.number
      AND len(list_intersect(a.words, b.words)) >= a.needed
      AND (b.share > a.share OR b.share = a.share AND b.shared > a.shared))
), matched AS (
  SELECT r, max(share) AS share, list(DISTINCT label) AS labels FROM kept GROUP BY r
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(b.n_base, 0) AS n_base, b.first_word, b.last_word,
  coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(b.labels, m.labels))), ','), '')
    AS labels,
  CASE WHEN b.n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(m.share, 0.0) END AS score
FROM worded d LEFT JOIN base b USING (r) LEFT JOIN matched m USING (r)
""".replace("TEMPLATES", _licence_templates())

# SHA-1 of the payload from hexadecimal to base32, five digits at a time.
WARC = """
WITH bodies AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages
), digests AS (
  SELECT page_id, strlen(body) AS n, to_base(('0x' || substr(sha1(body), 1, 5))::BIGINT, 32, 4)
    || to_base(('0x' || substr(sha1(body), 6, 5))::BIGINT, 32, 4)
    || to_base(('0x' || substr(sha1(body), 11, 5))::BIGINT, 32, 4)
    || to_base(('0x' || substr(sha1(body), 16, 5))::BIGINT, 32, 4)
    || to_base(('0x' || substr(sha1(body), 21, 5))::BIGINT, 32, 4)
    || to_base(('0x' || substr(sha1(body), 26, 5))::BIGINT, 32, 4)
    || to_base(('0x' || substr(sha1(body), 31, 5))::BIGINT, 32, 4)
    || to_base(('0x' || substr(sha1(body), 36, 5))::BIGINT, 32, 4) AS digits
  FROM bodies
), firsts AS (
  SELECT *, max(page_id) OVER (PARTITION BY digits, n) AS first_id FROM digests
)
SELECT page_id, n AS payload_bytes,
  translate(digits, '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')
    AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM firsts
"""

TOP_K = """
WITH sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM sound q JOIN sound c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""



# CRC-32 of the decimal document id, bit by bit.
CRC32 = """xor(list_reduce(
  list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
  lambda state, byte: list_reduce([xor(state, byte), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
    lambda x, bit: xor(x >> 1, (x & 1) * 3988292384)), 4294967295::BIGINT), 4294967295)"""


def _manifest_sql(levels: int = 6, top_levels: int = 4) -> str:
    """The trees level by level; so many levels hold 16 ** levels leaves a source, and as many
    sources as 16 ** top_levels."""

    def tree(name: str, height: int) -> list[str]:
        parts = []
        for i in range(height):
            parts.append(f"""{name}_runs{i} AS (
  SELECT tree, pos // 16 AS pos, max(held) AS held, list(digest ORDER BY pos) AS run
  FROM {name}{i} GROUP BY tree, pos // 16
), {name}{i + 1} AS (
  SELECT tree, pos, (held + 15) // 16 AS held,
         CASE WHEN held > 1 THEN sha256(array_to_string(run, '')) ELSE run[1] END AS digest
  FROM {name}_runs{i}
)""")
        return parts

    def folds(name: str, height: int, start: str, source: str) -> list[str]:
        parts, before = [], source
        for i in range(height):
            at = f"(p // {16**i}) % 16"
            left = f"array_to_string(r.run[1:{at}], '')"
            right = f"array_to_string(r.run[{at} + 2:], '')"
            parts.append(f"""{name}_fold{i} AS (
  SELECT b.* EXCLUDE (proof, folded),
    CASE WHEN r.held > 1 THEN b.proof || {left} || {right} ELSE b.proof END AS proof,
    CASE WHEN r.held > 1 THEN sha256({left} || b.folded || {right}) ELSE b.folded END AS folded
  FROM (SELECT *, {start} AS p FROM {before}) b
  JOIN {name}_runs{i} r ON r.tree = b.{name}_tree AND r.pos = b.p // {16 ** (i + 1)}
)""")
            before = f"(SELECT * EXCLUDE (p) FROM {name}_fold{i})"
        return parts

    one = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
    head = " || ".join(one.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    claimed = f"CASE WHEN {CRC32} % 5 = 0 THEN {lowered} ELSE text END"
    parts = [
        f"""leaves AS (
  SELECT doc_id, coalesce('+' || source, '') AS tree, sha256({head} || {one.format("text")}) AS digest,
         sha256({head} || {one.format(f"({claimed})")}) AS claimed
  FROM documents
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS held
  FROM leaves
), low0 AS (SELECT tree, pos, held, digest FROM numbered)""",
        *tree("low", levels),
        f"""subroots AS (
  SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS place FROM low{levels}
), top0 AS (
  SELECT 0 AS tree, place AS pos, (SELECT count(*) FROM subroots) AS held, digest FROM subroots
)""",
        *tree("top", top_levels),
        """started AS (
  SELECT n.doc_id, n.digest AS leaf, n.pos, n.tree AS low_tree, 0 AS top_tree, s.place,
         s.digest AS subroot, '' AS proof, n.claimed AS folded
  FROM numbered n JOIN subroots s USING (tree)
)""",
        *folds("low", levels, "pos", "started"),
        *folds("top", top_levels, "place", f"(SELECT * EXCLUDE (p) FROM low_fold{levels - 1})"),
    ]
    return f"""WITH {", ".join(parts)}
SELECT doc_id, leaf, subroot, t.digest AS root, sha256(proof) AS proof_sha256,
       folded AS folded_root, folded = t.digest AS verified
FROM top_fold{top_levels - 1}, top{top_levels} t"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_licences": LICENCES,
        "op5_mixing": MIXING,
        "op9_warc": WARC,
        "op10_top_k": TOP_K,
        "op11_manifest": _manifest_sql(),
    }
