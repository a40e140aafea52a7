"""The same queries as ANSI SQL over the same tables, for an independent engine."""

_LINES = """
line AS (
  SELECT l_orderkey, p_name, s_name,
         row_number() OVER (PARTITION BY l_orderkey
           ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS place
  FROM lineitem
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
)"""


def _tags(items: int) -> str:
    """Tags in rows of at most `items` lines."""
    return f"""{_LINES},
line_list AS (
  SELECT l_orderkey, CAST(place // {items} AS INTEGER) AS part,
         list(p_name ORDER BY place) AS units, list(s_name ORDER BY place) AS drivers
  FROM line GROUP BY 1, 2
),
line_count AS (
  SELECT l_orderkey AS counted, CAST(max(part) + 1 AS INTEGER) AS parts
  FROM line_list GROUP BY 1
),
tags AS (
  SELECT o_orderkey AS tag_id, coalesce(part, 0) AS part, coalesce(parts, 1) AS parts,
         CAST(coalesce(part, 0) AS BIGINT) * {items} AS first_item,
         CASE WHEN coalesce(part, 0) = 0 THEN 'Tag#' || o_orderkey END AS tag_name,
         CASE WHEN coalesce(part, 0) = 0
              THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS created_date,
         CASE WHEN coalesce(part, 0) = 0 AND c_custkey IS NOT NULL
              THEN [c_name] ELSE []::VARCHAR[] END AS accounts,
         coalesce(units, []::VARCHAR[]) AS units,
         coalesce(drivers, []::VARCHAR[]) AS drivers,
         CASE WHEN coalesce(part, 0) = 0 AND n_nationkey IS NOT NULL
              THEN [n_name, r_name] ELSE []::VARCHAR[] END AS areas
  FROM orders
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN line_list ON o_orderkey = l_orderkey
  LEFT JOIN line_count ON o_orderkey = counted
)"""


_ROW = 10_000  # lines a row holds unless a query asks for small parts
_TAGS = _tags(_ROW)
_PARTS = _tags(3)

_SECTIONS = """
sections AS (
  SELECT tag_id, part, parts, first_item, 0 AS section_ord, 'Accounts' AS label,
         accounts AS items FROM tags
  UNION ALL SELECT tag_id, part, parts, first_item, 1, 'Units', units FROM tags
  UNION ALL SELECT tag_id, part, parts, first_item, 2, 'Drivers', drivers FROM tags
  UNION ALL SELECT tag_id, part, parts, first_item, 3, 'Areas', areas FROM tags
)"""

_CHIPS = """
chips AS (
  SELECT tag_id, section_ord, label,
         first_item + unnest(range(len(items))) AS item_pos, unnest(items) AS item
  FROM sections
)"""

_COMMANDS = """
commands AS (
  SELECT user_id AS tag_id, ts, event_id AS seq,
         CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN '' WHEN 'signup' THEN ' '
              ELSE event_type || '-' || json_extract_string(props, '$.k') END AS new_name
  FROM events
)"""

_LATEST = """
latest AS (
  SELECT tag_id, new_name FROM (
    SELECT tag_id, new_name,
           row_number() OVER (PARTITION BY tag_id ORDER BY ts DESC, seq DESC) AS age
    FROM commands WHERE new_name <> ''
  ) WHERE age = 1
)"""

_AUDIT = """
SELECT c.tag_id, ts, seq, new_name,
       coalesce(earlier, tag_name) AS name_shown,
       coalesce(new_name <> '', false) AS accepted,
       coalesce(nullif(new_name, ''), earlier, tag_name) AS name_after
FROM (
  SELECT *, last_value(nullif(new_name, '') IGNORE NULLS) OVER (
           PARTITION BY tag_id ORDER BY ts, seq
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier
  FROM commands
) c
JOIN (SELECT o_orderkey AS tag_id, 'Tag#' || o_orderkey AS tag_name FROM orders) t
  ON c.tag_id = t.tag_id"""

_COUNTS = """
SELECT c_custkey AS user_id, count(event_id) AS "count"
FROM customer LEFT JOIN events ON c_custkey = user_id GROUP BY 1"""

_LISTS = ", ".join(
    f"CAST(to_json({c}) AS VARCHAR) AS {c}" for c in ("accounts", "units", "drivers", "areas")
)

_RUNNING = """
SELECT user_id, ts, event_id, running_count, running_count * 2 AS double_count
FROM (SELECT user_id, ts, event_id,
             row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS running_count
      FROM events)"""

_WHOSE = "tag_id, part, parts, first_item"


def _records(tags: str) -> str:
    return f"""
WITH {tags}
SELECT {_WHOSE}, tag_name, created_date, {_LISTS} FROM tags"""


def _section_rows(tags: str) -> str:
    return f"""
WITH {tags}, {_SECTIONS}
SELECT {_WHOSE}, section_ord, label, CAST(to_json(items) AS VARCHAR) AS items
FROM sections WHERE part = 0 OR len(items) > 0"""


def _section_sizes(tags: str) -> str:
    return f"""
WITH {tags}, {_SECTIONS}
SELECT tag_id, section_ord, label, CAST(sum(len(items)) AS BIGINT) AS n_items
FROM sections GROUP BY 1, 2, 3"""


def _chip_rows(tags: str) -> str:
    return f"""
WITH {tags}, {_SECTIONS}, {_CHIPS}
SELECT tag_id, section_ord, label, item_pos, item FROM chips"""


def _cards(tags: str) -> str:
    return f"""
WITH {tags}
SELECT tag_id, part, CAST(to_json({{
         'tag_id': tag_id, 'part': part, 'parts': parts, 'first_item': first_item,
         'title': tag_name,
         'fields': {{'Tag Name': tag_name, 'Created Date': created_date}},
         'sections': {{'Accounts': accounts, 'Units': units,
                       'Drivers': drivers, 'Areas': areas}}
       }}) AS VARCHAR) AS card
FROM tags"""


def _current(tags: str) -> str:
    return f"""
WITH {tags}, {_COMMANDS}, {_LATEST}
SELECT {_WHOSE}, coalesce(CASE WHEN part = 0 THEN new_name END, tag_name) AS tag_name,
       created_date, {_LISTS}
FROM tags LEFT JOIN latest USING (tag_id)"""


def _duplicates(tags: str) -> str:
    return f"""
WITH {tags}, {_SECTIONS}, {_CHIPS}
SELECT tag_id, section_ord, label, item, count(*) AS n, min(item_pos) AS first_pos
FROM chips
GROUP BY tag_id, section_ord, label, item HAVING count(*) > 1"""


ORACLE_SQL = {
    "tag_records": _records(_TAGS),
    "tag_records_parts": _records(_PARTS),
    "tag_titles": """
SELECT o_orderkey AS tag_id, 'Tag#' || o_orderkey AS tag_name FROM orders""",
    "tag_fields": """
SELECT o_orderkey AS tag_id, CAST(0 AS INTEGER) AS field_ord, 'Tag Name' AS label,
       'Tag#' || o_orderkey AS value FROM orders
UNION ALL
SELECT o_orderkey, 1, 'Created Date', strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') FROM orders""",
    "tag_sections": _section_rows(_TAGS),
    "tag_sections_parts": _section_rows(_PARTS),
    "tag_section_entries": _section_sizes(_TAGS),
    "tag_section_entries_parts": _section_sizes(_TAGS),
    "tag_chips": _chip_rows(_TAGS),
    "tag_chips_parts": _chip_rows(_PARTS),
    "tag_chips_split": _chip_rows(_PARTS),
    "tag_cards": _cards(_TAGS),
    "tag_cards_parts": _cards(_PARTS),
    "accepted_renames": f"""
WITH {_COMMANDS}
SELECT tag_id, ts, seq, new_name FROM commands WHERE new_name IS NOT NULL AND new_name <> ''""",
    "current_tags": _current(_TAGS),
    "current_tags_parts": _current(_PARTS),
    "rename_audit": f"""
WITH {_COMMANDS} {_AUDIT}""",
    "rename_audit_split": f"""
WITH {_COMMANDS} {_AUDIT}""",
    "current_fields_stream": f"""
WITH {_COMMANDS}, {_LATEST}
SELECT o_orderkey AS tag_id, CAST(0 AS INTEGER) AS field_ord, 'Tag Name' AS label,
       coalesce(new_name, 'Tag#' || o_orderkey) AS value
FROM orders LEFT JOIN latest ON o_orderkey = tag_id
UNION ALL
SELECT o_orderkey, 1, 'Created Date', strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') FROM orders""",
    "current_tag_outputs": f"""
WITH {_TAGS}, {_COMMANDS}, {_LATEST}, {_SECTIONS}, {_CHIPS},
names AS (
  SELECT tag_id, coalesce(new_name, tag_name) AS tag_name, created_date
  FROM tags LEFT JOIN latest USING (tag_id) WHERE part = 0
)
SELECT tag_id, 'title' AS output, CAST(0 AS INTEGER) AS ord, '' AS label,
       CAST(0 AS BIGINT) AS pos, tag_name AS value FROM names
UNION ALL SELECT tag_id, 'field', 0, 'Tag Name', 0, tag_name FROM names
UNION ALL SELECT tag_id, 'field', 1, 'Created Date', 0, created_date FROM names
UNION ALL SELECT tag_id, 'section', section_ord, label, item_pos, item FROM chips
UNION ALL SELECT tag_id, 'section', section_ord, label, -1, NULL
          FROM sections WHERE part = 0 AND len(items) = 0""",
    "event_counter": _COUNTS,
    "double_counter": f"""
SELECT user_id, "count", "count" * 2 AS double_count FROM ({_COUNTS})""",
    "running_counter": _RUNNING,
    "running_counter_split": _RUNNING,
    "running_counter_global": """
SELECT user_id, ts, event_id, row_number() OVER (ORDER BY ts, event_id) AS running_count
FROM events""",
    "prop_violations": """
SELECT conv_id, turn, 'missing' AS violation FROM conversations
WHERE role = 'system' OR text IS NULL""",
    "prop_violations_json": """
SELECT event_id, CASE WHEN kind IS NULL THEN 'missing' ELSE 'wrong_type' END AS violation
FROM (SELECT event_id, json_type(props, '$.k') AS kind FROM events)
WHERE kind IS NULL OR kind <> 'VARCHAR'""",
    "duplicate_chip_keys": _duplicates(_TAGS),
    "duplicate_chip_keys_parts": _duplicates(_PARTS),
    "text_contains": """
SELECT doc_id, text FROM documents WHERE contains(text, 'the')""",
    "text_contains_rare": """
SELECT doc_id, text FROM documents WHERE contains(text, 'MIT License')""",
}

# A stream that has seen everything, and rows that are stored otherwise, hold what the batch
# query gives.
for _streamed, _batch in {
    "tag_chips_stream": "tag_chips",
    "tag_cards_stream": "tag_cards",
    "current_chips_stream": "tag_chips",
    "duplicate_chip_keys_stream": "duplicate_chip_keys",
    "prop_violations_json_stream": "prop_violations_json",
    "accepted_renames_stream": "accepted_renames",
    "current_tags_stream": "current_tags",
    "rename_audit_stream": "rename_audit",
    "rename_audit_late_stream": "rename_audit",
    "current_tag_outputs_stream": "current_tag_outputs",
    "event_counter_stream": "double_counter",
    "running_counter_stream": "running_counter",
    "running_counter_global_stream": "running_counter_global",
    "text_contains_indexed": "text_contains",
    "current_tags_bucketed": "current_tags",
    "rename_audit_bucketed": "rename_audit",
    "duplicate_chip_keys_per_row": "duplicate_chip_keys",
}.items():
    ORACLE_SQL[_streamed] = ORACLE_SQL[_batch]
