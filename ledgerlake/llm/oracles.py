"""DuckDB SQL for the corpus queries that SQL can state.

Not here: op2 and op4 (components of a similarity join need an iteration over
all pairs), op3 (the tree's cuts), op5 to op7 (fitted models), op8 (the
backoff weights over whole tables), op10 (mined rules for the rest of the
urls). tests/llm checks these against brute force.
"""

from __future__ import annotations

_WORDS = ("list_filter(string_split_regex(translate(coalesce(text, ''), "
          "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')")

OP1 = f"""
WITH item_words AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
item AS (SELECT DISTINCT item_id, least(len(ws), 5) AS w,
                unnest(list_transform(range(1, len(ws) - least(len(ws), 5) + 2),
                    lambda i: array_to_string(ws[i:i + least(len(ws), 5) - 1], ' '))) AS shingle
         FROM item_words WHERE len(ws) > 0),
size AS (SELECT item_id, count(*) AS n_item FROM item GROUP BY item_id),
doc_words AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
doc AS (SELECT DISTINCT doc_id, w, unnest(list_transform(range(1, len(ws) - w + 2),
                    lambda i: array_to_string(ws[i:i + w - 1], ' '))) AS shingle
        FROM doc_words, (SELECT DISTINCT w FROM item) WHERE len(ws) >= w),
hit AS (SELECT doc_id, item_id, count(*) AS n_shared
        FROM doc JOIN item USING (w, shingle) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_item, n_shared, n_shared::DOUBLE / n_item AS containment
FROM hit JOIN size USING (item_id)
WHERE n_shared * 100 >= n_item * 80
"""

OP9 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
lead AS (SELECT body, max(page_id) AS leader FROM p WHERE strlen(body) >= 1000 GROUP BY body)
SELECT page_id, strlen(p.body)::BIGINT AS payload_bytes, sha1(p.body) AS payload_digest,
       CASE WHEN leader IS NOT NULL AND page_id IS DISTINCT FROM leader
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN leader IS NOT NULL AND page_id IS DISTINCT FROM leader
            THEN leader END AS refers_to
FROM p LEFT JOIN lead ON p.body = lead.body
"""

OP11 = """
WITH l AS (SELECT doc_id, i AS pos, ls[i] AS line,
                  translate(trim(ls[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
           FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
                unnest(range(1, len(ls) + 1)) AS u(i)),
often AS (SELECT k, max(doc_id) AS keeper FROM l WHERE length(k) >= 20
          GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT doc_id, pos, line, keeper IS NOT NULL AND doc_id <> keeper AS gone
           FROM l LEFT JOIN often USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), ''))
           AS kept_sha256
FROM marked GROUP BY doc_id
"""

ORACLES = {"op1_decontaminate": OP1, "op9_warc": OP9, "op11_line_dedup": OP11}
