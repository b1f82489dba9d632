"""DuckDB SQL for every catalog query, over the driver's raw tables.

Each statement starts with the same CTEs that bind the logical tables
(``riskgraph.sources.bindings`` written in SQL), then the query.  Column names
and types match the Spark results.  Mean durations are turned into
two-decimal text with integer arithmetic (half up on exact cents), which is
what the JVM's ``%.2f`` gives on these inputs; DuckDB's own ``printf`` rounds
ties to even on the binary value.
"""

from __future__ import annotations

DAY = "'2001-08-31'"
TODAY = "'2001-09-01'"


def _u(k: str) -> str:
    return f"'1' || lpad(CAST(CASE WHEN {k} % 20 = 1 THEN {k} - 1 ELSE {k} END AS VARCHAR), 10, '0')"


def _m(k: str) -> str:
    return f"'1' || lpad(CAST({k} AS VARCHAR), 10, '0')"


BINDINGS = f"""
user_contact AS (
  SELECT c_custkey AS user_id, c_mktsegment AS ds,
         CASE WHEN c_custkey % 8 = 7 THEN '2001-08-30' ELSE '2001-08-31' END AS dt,
         {_u('c_custkey')} AS mobile
  FROM customer),
per_cust AS (
  SELECT o_custkey,
         min(o_orderdate) AS t_all,
         min(CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate END) AS t_urgent,
         min(CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN o_orderdate END) AS t_urgent_f,
         count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS n_open
  FROM orders GROUP BY o_custkey),
user_profile AS (
  SELECT c_custkey AS user_id, c_mktsegment AS ds,
         CASE WHEN c_custkey % 10 = 9 THEN '2001-08-30' ELSE '2001-08-31' END AS dt,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE t_all END AS first_apply_credit_time,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE t_urgent END AS first_apply_credit_succ_time,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE t_urgent_f END AS first_apply_loan_succ_time,
         CAST(CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_custkey * 7 % 25 END AS INTEGER) AS max_overdue_day_cnt,
         CAST(CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE coalesce(n_open, 0) % 3 END AS INTEGER) AS curr_inloan_cnt,
         CAST(c_custkey % 7 AS INTEGER) AS max_prepayment_day_cnt,
         reverse({_u('c_custkey')}) AS mobile_encode
  FROM customer LEFT JOIN per_cust ON c_custkey = o_custkey),
call_rows AS (
  SELECT {_m('o_custkey')} AS mobile,
         CASE WHEN l_linenumber = 7 THEN '0' ELSE '1' END || lpad(CAST(l_suppkey AS VARCHAR), 10, '0') AS other_mobile,
         CASE WHEN l_returnflag = 'R' THEN '012001002' ELSE '012001001' END AS call_channel,
         CASE WHEN l_linenumber = 5 THEN NULL WHEN l_linenumber = 6 THEN 'n/a'
              ELSE CAST(CAST(trunc(l_quantity) AS INTEGER) * 60 AS VARCHAR) END AS call_time,
         l_shipdate, l_linenumber, l_suppkey, l_returnflag, l_linestatus
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
call_detail AS (
  SELECT mobile, other_mobile, call_channel, call_time, strftime(l_shipdate, '%Y-%m-%d') AS dt FROM call_rows),
call_detail_dirty AS (
  SELECT mobile,
         CASE WHEN l_linenumber = 6 THEN '1' || lpad(CAST(l_suppkey AS VARCHAR), 7, '0') ELSE other_mobile END AS other_mobile,
         CASE WHEN l_linenumber = 4 AND l_linestatus = 'F' AND l_returnflag <> 'R' THEN '012001009'
              ELSE call_channel END AS call_channel,
         call_time, strftime(l_shipdate, '%Y-%m-%d') AS dt FROM call_rows),
call_detail_year AS (
  SELECT mobile, other_mobile, call_channel, call_time,
         strftime(date_trunc('year', l_shipdate), '%Y-%m-%d') AS dt FROM call_rows),
repay_plan AS (
  SELECT o_orderkey AS loan_id, o_custkey AS user_id, c_mktsegment AS ds,
         CAST(greatest(0, 30 - date_diff('day', o_orderdate, l_shipdate)) AS INTEGER) AS early_day,
         CAST(greatest(0, date_diff('day', o_orderdate, l_shipdate) - 30) AS INTEGER) AS overdue_day,
         CASE WHEN l_linestatus = 'F' THEN '002005002' ELSE '002005001' END AS repay_status,
         o_orderdate AS create_time, l_shipdate AS due_day, '2001-08-31' AS dt
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
collection_record AS (
  SELECT o_orderkey AS loan_id, c_mktsegment AS ds,
         CASE WHEN o_orderpriority = '5-LOW' AND o_totalprice > 450000 THEN 'FRAUD' ELSE 'OTHER' END AS loan_name,
         '2001-08-31' AS dt
  FROM orders JOIN customer ON o_custkey = c_custkey),
third_party_blacklist AS (
  SELECT {_m('c_custkey')} AS mobile,
         CASE WHEN c_nationkey <> 3 OR c_custkey % 5 = 4 THEN '2001-08-30' ELSE '2001-08-31' END AS dt
  FROM customer),
credit_apply AS (
  SELECT o_custkey AS user_id, c_mktsegment AS ds, o_orderdate AS apply_time, '2001-08-31' AS dt
  FROM orders JOIN customer ON o_custkey = c_custkey),
rank_score AS (
  SELECT uc.mobile AS mobile, c.c_acctbal AS score FROM customer c JOIN user_contact uc ON c.c_custkey = uc.user_id),
"""

DERIVED = f"""
applied AS (
  SELECT DISTINCT c.mobile FROM user_profile p JOIN user_contact c ON p.user_id = c.user_id AND p.ds = c.ds
  WHERE p.dt = {DAY} AND c.dt = {DAY} AND p.first_apply_credit_time IS NOT NULL AND c.mobile IS NOT NULL),
passed_rows AS (
  SELECT c.mobile, p.first_apply_loan_succ_time, p.max_overdue_day_cnt, p.curr_inloan_cnt, p.max_prepayment_day_cnt
  FROM user_profile p JOIN user_contact c ON p.user_id = c.user_id AND p.ds = c.ds
  WHERE p.dt = {DAY} AND c.dt = {DAY} AND p.first_apply_credit_succ_time IS NOT NULL),
passed AS (
  SELECT mobile, max(first_apply_loan_succ_time) AS first_apply_loan_succ_time,
         max(max_overdue_day_cnt) AS max_overdue_day_cnt, max(curr_inloan_cnt) AS curr_inloan_cnt,
         max(max_prepayment_day_cnt) AS max_prepayment_day_cnt
  FROM passed_rows WHERE mobile IS NOT NULL GROUP BY mobile),
history AS (SELECT * FROM call_detail WHERE dt < {DAY}),
history_to_today AS (SELECT * FROM call_detail WHERE dt < {TODAY}),
dirty_history AS (SELECT * FROM call_detail_dirty WHERE dt < {DAY}),
known_dirty AS (SELECT * FROM call_detail_dirty WHERE dt < {TODAY} AND call_channel IN ('012001001', '012001002')),
new_applicants AS (
  SELECT DISTINCT c.mobile FROM credit_apply a JOIN user_contact c ON a.user_id = c.user_id AND a.ds = c.ds
  WHERE a.dt = '2001-08-31' AND c.dt = '2001-08-31' AND CAST(a.apply_time AS VARCHAR) > '2001-06-01'
    AND c.mobile IS NOT NULL),
fraud_ids AS (
  SELECT DISTINCT loan_id FROM collection_record
  WHERE dt = {DAY} AND ds IN ('BUILDING', 'AUTOMOBILE') AND loan_name = 'FRAUD'),
day_contact AS (SELECT user_id, ds, mobile FROM user_contact WHERE dt = {DAY}),
fraud AS (
  SELECT k.mobile FROM repay_plan r SEMI JOIN fraud_ids USING (loan_id) LEFT JOIN day_contact k USING (user_id, ds)
  WHERE r.dt = {DAY}),
counted_plans AS (
  SELECT * FROM repay_plan
  WHERE dt = {DAY} AND create_time >= TIMESTAMP '1998-10-01 00:00:00'
    AND (due_day < TIMESTAMP '2001-09-01 00:00:00' OR repay_status = '002005002')),
loan_maxima AS (
  SELECT ds, user_id, loan_id, max(overdue_day) AS overdue_day, max(early_day) AS early_day
  FROM counted_plans GROUP BY ALL),
overdue AS (
  SELECT m.loan_id, m.ds, reverse(p.mobile_encode) AS mobile, m.early_day, m.overdue_day
  FROM user_profile p JOIN loan_maxima m USING (user_id, ds) WHERE p.dt = {DAY}),
oriented_valid AS (
  SELECT CASE WHEN call_channel = '012001001' THEN mobile WHEN call_channel = '012001002' THEN other_mobile END AS src,
         CASE WHEN call_channel = '012001001' THEN other_mobile WHEN call_channel = '012001002' THEN mobile END AS dst,
         CASE WHEN regexp_full_match(call_time, '[0-9]+') THEN CAST(call_time AS DOUBLE) ELSE 0.0 END AS duration
  FROM history
  WHERE regexp_full_match(mobile, '1[0-9]{{10}}') AND regexp_full_match(other_mobile, '1[0-9]{{10}}')),
dirty AS (
  SELECT CASE substring(other_mobile, 11, 1)
           WHEN '1' THEN 'p0086' || other_mobile || ';cpc'
           WHEN '2' THEN 'p86' || other_mobile
           WHEN '3' THEN 'p' || other_mobile || ';cpc'
           WHEN '4' THEN 'p(86)' || other_mobile
           WHEN '5' THEN 'p86' || other_mobile || ';cpc'
           ELSE 'p' || other_mobile END AS raw
  FROM history),
rank_pairs AS (
  SELECT DISTINCT src, dst FROM
    (SELECT CASE WHEN call_channel = '012001001' THEN mobile WHEN call_channel = '012001002' THEN other_mobile END AS src,
            CASE WHEN call_channel = '012001001' THEN other_mobile WHEN call_channel = '012001002' THEN mobile END AS dst
     FROM history_to_today)
  WHERE src IN (SELECT mobile FROM applied) AND dst IN (SELECT mobile FROM applied)
    AND regexp_full_match(src, '1[0-9]{{10}}') AND regexp_full_match(dst, '1[0-9]{{10}}'))
"""

PREFIX = "WITH " + BINDINGS + DERIVED


def _q(body: str) -> str:
    return PREFIX + body


def _edges(source: str, where: str, pattern: str, min_n: int = 2, prefix: str = "") -> str:
    """Directed pairs with calls, mean and two-decimal mean text."""
    m = f"'{prefix}' || mobile" if prefix else "mobile"
    o = f"'{prefix}' || other_mobile" if prefix else "other_mobile"
    return f"""
SELECT src, dst, calls, mean_duration,
       CAST(cents // 100 AS VARCHAR) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS mean_text
FROM (
  SELECT src, dst, count(*) AS calls, sum(duration) / count(*) AS mean_duration,
         (200 * CAST(sum(duration) AS BIGINT) + count(*)) // (2 * count(*)) AS cents
  FROM (
    SELECT CASE WHEN call_channel = '012001001' THEN {m} WHEN call_channel = '012001002' THEN {o} END AS src,
           CASE WHEN call_channel = '012001001' THEN {o} WHEN call_channel = '012001002' THEN {m} END AS dst,
           CASE WHEN regexp_full_match(call_time, '[0-9]+') THEN CAST(call_time AS DOUBLE) ELSE 0.0 END AS duration
    FROM {source}
    WHERE {where}
      AND regexp_full_match({m}, '{pattern}') AND regexp_full_match({o}, '{pattern}'))
  GROUP BY src, dst
  HAVING count(*) >= {min_n})
"""


STRICT = "1[0-9]{10}"
LOOSE = "p1[0-9]{5,10}"
ANY11 = "[0-9]{11}"

C15 = _edges("history", "mobile IN (SELECT mobile FROM applied) AND other_mobile IN (SELECT mobile FROM applied)",
             STRICT)

C15_TODAY = _edges("history_to_today",
                   "mobile IN (SELECT mobile FROM applied) AND other_mobile IN (SELECT mobile FROM applied)", STRICT)


def _list(cond: str) -> str:
    return f"SELECT DISTINCT mobile FROM passed WHERE {cond}"


LOAN = "first_apply_loan_succ_time IS NOT NULL"
OD = "coalesce(max_overdue_day_cnt, 0)"

ORACLE: dict[str, str] = {
    "c01_applied": _q("SELECT mobile FROM applied"),
    "c02_applied_not_passed": _q(f"""
SELECT DISTINCT c.mobile AS mobile FROM user_profile p JOIN user_contact c ON p.user_id = c.user_id AND p.ds = c.ds
WHERE p.dt = {DAY} AND c.dt = {DAY} AND p.first_apply_credit_time IS NOT NULL
  AND p.first_apply_credit_succ_time IS NULL AND c.mobile IS NOT NULL"""),
    "c03_passed_summary": _q("""
SELECT mobile, CAST(first_apply_loan_succ_time AS VARCHAR) AS first_apply_loan_succ_time,
       max_overdue_day_cnt, curr_inloan_cnt, max_prepayment_day_cnt FROM passed"""),
    "c04_passed_no_borrow": _q(_list("first_apply_loan_succ_time IS NULL")),
    "c05_whitelist": _q(_list(f"{LOAN} AND {OD} <= 7 AND coalesce(curr_inloan_cnt, 0) = 0")),
    "c06_whitelist_strict": _q(_list(f"{LOAN} AND {OD} <= 7 AND coalesce(curr_inloan_cnt, 0) = 0 "
                                     "AND coalesce(max_prepayment_day_cnt, 0) <= 3")),
    "c07_whitelist_early": _q(_list(f"{LOAN} AND {OD} <= 7")),
    "c08_greylist": _q(_list(f"{LOAN} AND {OD} > 7 AND {OD} <= 14")),
    "c09_blacklist": _q(_list(f"{LOAN} AND {OD} > 14")),
    "c10_blacklist_wide": _q(_list(f"{LOAN} AND {OD} >= 7")),
    "c11_third_party": _q(f"SELECT mobile FROM third_party_blacklist WHERE dt = {DAY}"),
    "c12_fraud_history": _q("SELECT mobile FROM fraud"),
    "c13_merged_blacklist": _q(f"""
SELECT DISTINCT mobile FROM (
  SELECT mobile FROM passed WHERE {LOAN} AND {OD} > 14
  UNION ALL SELECT mobile FROM third_party_blacklist WHERE dt = {DAY}
  UNION ALL SELECT mobile FROM fraud)
WHERE mobile IS NOT NULL"""),
    "c14_segments_per_user": _q(f"""
SELECT DISTINCT list, 'p' || mobile AS mobile FROM (
  SELECT 'applycreditNoBorrow' AS list, mobile FROM passed_rows WHERE first_apply_loan_succ_time IS NULL
  UNION ALL SELECT 'borrowNotwb', mobile FROM passed_rows WHERE {LOAN} AND {OD} > 7 AND {OD} <= 14
  UNION ALL SELECT 'whitelist', mobile FROM passed_rows WHERE {LOAN} AND {OD} <= 7
  UNION ALL SELECT 'blacklist', mobile FROM passed_rows WHERE {LOAN} AND {OD} > 14)
WHERE mobile IS NOT NULL"""),
    "c15_call_edges": _q(C15),
    "c16_call_edges_loose": _q(_edges("history_to_today", "TRUE", LOOSE, prefix="p")),
    "c15_call_edges_to_today": _q(C15_TODAY),
    "c15_call_edges_shuffled": _q(C15),
    "c22_rank_edges_shuffled": _q("SELECT src, dst FROM rank_pairs"),
    "c16_call_edges_loose_drop": _q(_edges("known_dirty", "TRUE", LOOSE, prefix="p")),
    "c17_call_edges_owner": _q(_edges("history_to_today", "mobile IN (SELECT mobile FROM passed)", STRICT)),
    "c17_call_edges_bucketed": _q(_edges("history_to_today", "mobile IN (SELECT mobile FROM passed)", STRICT)),
    "c18_call_edges_passed": _q(_edges(
        "history_to_today", "mobile IN (SELECT mobile FROM passed) AND other_mobile IN (SELECT mobile FROM passed)", ANY11)),
    "c19_incremental_applicants": _q("SELECT mobile FROM new_applicants"),
    "c20_incremental_edges": _q(_edges(
        "call_detail_year", "dt = '2001-01-01' AND mobile IN (SELECT mobile FROM new_applicants) "
        "AND other_mobile IN (SELECT mobile FROM new_applicants)", STRICT)),
    "c20_incremental_edges_all": _q(_edges(
        "call_detail_year", "dt = '2001-01-01' AND mobile IN (SELECT mobile FROM new_applicants) "
        "AND other_mobile IN (SELECT mobile FROM new_applicants)", STRICT, min_n=1)),
    "c20_incremental_edges_mixed": _q(_edges(
        "call_detail_year", "dt = '2001-01-01' AND mobile IN (SELECT mobile FROM new_applicants) "
        "AND other_mobile IN (SELECT mobile FROM applied)", STRICT, min_n=1)),
    "c20_incremental_edges_loose": _q(_edges("call_detail_year", "dt = '2001-01-01'", LOOSE, min_n=1, prefix="p")),
    "c21_persons": _q(f"""
SELECT DISTINCT mobile FROM (SELECT src AS mobile FROM ({C15}) UNION ALL SELECT dst FROM ({C15}))"""),
    "c22_rank_edges": _q("SELECT src, dst FROM rank_pairs"),
    "c23_one_degree": _q("""
SELECT src AS mobile, string_agg(dst, chr(9) ORDER BY dst) AS neighbours FROM rank_pairs GROUP BY src"""),
    "c24_one_degree_undirected": _q("""
SELECT mobile, string_agg(nb, chr(9) ORDER BY nb) AS neighbours FROM (
  SELECT DISTINCT mobile, nb FROM (SELECT src AS mobile, dst AS nb FROM rank_pairs
                                   UNION ALL SELECT dst, src FROM rank_pairs))
GROUP BY mobile"""),
    "c15_call_edges_from_totals": _q(C15),
    "c22_rank_edges_from_totals": _q("SELECT src, dst FROM rank_pairs"),
    "c27_graph_lists": _q(f"""
SELECT 'applyNotPass' AS list, mobile FROM (
  SELECT DISTINCT c.mobile AS mobile FROM user_profile p JOIN user_contact c ON p.user_id = c.user_id AND p.ds = c.ds
  WHERE p.dt = {DAY} AND c.dt = {DAY} AND p.first_apply_credit_time IS NOT NULL
    AND p.first_apply_credit_succ_time IS NULL AND c.mobile IS NOT NULL)
UNION ALL SELECT 'applycreditNoBorrow', mobile FROM passed WHERE first_apply_loan_succ_time IS NULL
UNION ALL SELECT 'borrowNotwb', mobile FROM passed WHERE {LOAN} AND {OD} > 7 AND {OD} <= 14
UNION ALL SELECT 'whitelist', mobile FROM passed WHERE {LOAN} AND {OD} <= 7 AND coalesce(curr_inloan_cnt, 0) = 0
UNION ALL SELECT 'blacklist', mobile FROM passed WHERE {LOAN} AND {OD} > 14"""),
    "c25_overdue_info": _q("SELECT loan_id, ds, mobile, early_day, overdue_day FROM overdue"),
    "c26_score_vs_overdue": _q("""
SELECT s.score AS score, f.overdue_day AS overdue_day
FROM (SELECT DISTINCT loan_id, ds, mobile, early_day, overdue_day FROM overdue) f
JOIN rank_score s ON f.mobile = s.mobile"""),
    "c26_score_vs_overdue_split": _q("""
SELECT s.score AS score, f.overdue_day AS overdue_day
FROM (SELECT DISTINCT loan_id, ds, mobile, early_day, overdue_day FROM overdue) f
JOIN rank_score s ON f.mobile = s.mobile"""),
}


ORIENT = """CASE WHEN call_channel = '012001001' THEN mobile WHEN call_channel = '012001002' THEN other_mobile END AS src,
       CASE WHEN call_channel = '012001001' THEN other_mobile WHEN call_channel = '012001002' THEN mobile END AS dst"""
A3 = _edges("history", "TRUE", STRICT, min_n=1)
WHITE = f"{LOAN} AND {OD} <= 7 AND coalesce(curr_inloan_cnt, 0) = 0"
GREY = f"{LOAN} AND {OD} > 7 AND {OD} <= 14"
BLACK = f"{LOAN} AND {OD} > 14"
SCORES = """SELECT s.score AS score, f.overdue_day AS overdue_day
FROM (SELECT DISTINCT loan_id, ds, mobile, early_day, overdue_day FROM overdue) f
JOIN rank_score s ON f.mobile = s.mobile"""
MEMBERS_BOTH = "mobile IN (SELECT mobile FROM {m}) AND other_mobile IN (SELECT mobile FROM {m})"

ORACLE.update({
    "s1_snapshot": _q(f"SELECT user_id, ds, mobile FROM user_contact WHERE dt = {DAY}"),
    "s2_history": _q("SELECT mobile, other_mobile, call_channel, call_time, dt FROM history"),
    "s3_day_increment": _q("SELECT mobile, other_mobile, call_channel, call_time FROM call_detail_year "
                           "WHERE dt = '2001-01-01'"),
    "s6_registered_view": _q("SELECT mobile FROM applied"),
    "p1_projection": _q(f"SELECT user_id AS uid, ds AS channel, max_overdue_day_cnt AS overdue "
                        f"FROM user_profile WHERE dt = {DAY}"),
    "p2_orient_calls": _q(f"SELECT {ORIENT}, call_time FROM history"),
    "p3_reverse_edges": _q("SELECT dst AS src, src AS dst FROM rank_pairs"),
    "p4_split_pair": _q("SELECT src, dst FROM rank_pairs"),
    "p5_edge_nodes": _q("SELECT src AS mobile FROM rank_pairs UNION ALL SELECT dst FROM rank_pairs"),
    "f1_lifecycle_nulls": _q(f"SELECT user_id, ds FROM user_profile WHERE dt = {DAY} "
                             "AND first_apply_credit_time IS NOT NULL AND first_apply_credit_succ_time IS NULL"),
    "f2_null_as_zero_threshold": _q(f"SELECT mobile, max_overdue_day_cnt FROM passed WHERE {OD} <= 7"),
    "f3_due_or_settled": _q(f"""
SELECT loan_id, user_id, ds, early_day, overdue_day FROM repay_plan
WHERE dt = {DAY} AND CAST(create_time AS DATE) >= DATE '1998-10-01'
  AND (repay_status = '002005002' OR CAST(due_day AS DATE) <= DATE '2001-08-31')"""),
    "f4_fraud_loans": _q(f"SELECT loan_id FROM collection_record WHERE dt = {DAY} AND loan_name = 'FRAUD' "
                         "AND ds IN ('BUILDING', 'AUTOMOBILE')"),
    "f5_later_than_day": _q(f"SELECT user_id, ds FROM credit_apply WHERE dt = {DAY} "
                            "AND CAST(apply_time AS VARCHAR) > '2001-06-01'"),
    "f6_valid_pairs": _q(f"SELECT mobile, other_mobile FROM dirty_history WHERE regexp_full_match(mobile, '{STRICT}') "
                         f"AND regexp_full_match(other_mobile, '{STRICT}')"),
    "f7_valid_pairs_loose": _q(f"""
SELECT 'p' || mobile AS mobile, 'p' || other_mobile AS other_mobile FROM dirty_history
WHERE regexp_full_match('p' || mobile, '{LOOSE}') AND regexp_full_match('p' || other_mobile, '{LOOSE}')"""),
    "f8_valid_pairs_any11": _q(f"SELECT mobile, other_mobile FROM dirty_history WHERE regexp_full_match(mobile, '{ANY11}') "
                               f"AND regexp_full_match(other_mobile, '{ANY11}')"),
    "f9_min_calls": _q("SELECT src, dst, count(*) AS calls FROM oriented_valid GROUP BY src, dst HAVING count(*) >= 2"),
    "j1_with_contact": _q(f"""
SELECT p.user_id AS user_id, p.ds AS ds, c.mobile AS mobile
FROM user_profile p JOIN user_contact c ON p.user_id = c.user_id AND p.ds = c.ds
WHERE p.dt = {DAY} AND c.dt = {DAY}"""),
    "j2_left_join_day_in_on": _q(f"""
SELECT r.loan_id AS loan_id, r.user_id AS user_id, c.mobile AS mobile
FROM repay_plan r LEFT JOIN user_contact c ON r.user_id = c.user_id AND r.ds = c.ds AND c.dt = {DAY}
WHERE r.dt = {DAY}"""),
    "j3_in_subquery": _q(f"""
SELECT loan_id, user_id, ds FROM repay_plan WHERE dt = {DAY} AND loan_id IN
  (SELECT loan_id FROM collection_record WHERE dt = {DAY} AND loan_name = 'FRAUD' AND ds IN ('BUILDING', 'AUTOMOBILE'))"""),
    "j4_between_members": _q("SELECT mobile, other_mobile, call_channel, call_time FROM history WHERE "
                             + MEMBERS_BOTH.format(m="applied")),
    "j5_between_members_broadcast": _q("SELECT mobile, other_mobile, call_channel, call_time FROM history WHERE "
                                       + MEMBERS_BOTH.format(m="applied")),
    "j6_between_passed": _q("SELECT mobile, other_mobile, call_channel, call_time FROM history WHERE "
                            + MEMBERS_BOTH.format(m="passed")),
    "j7_owned_by_members": _q("SELECT mobile, other_mobile, call_channel, call_time FROM history "
                              "WHERE mobile IN (SELECT mobile FROM passed)"),
    "j8_scores_by_mobile": _q("""
SELECT f.mobile AS mobile, f.loan_id AS loan_id, s.score AS score
FROM (SELECT DISTINCT loan_id, ds, mobile, early_day, overdue_day FROM overdue) f
JOIN rank_score s ON f.mobile = s.mobile"""),
    "a1_max_per_mobile": _q("SELECT mobile, max_overdue_day_cnt, curr_inloan_cnt FROM passed"),
    "a2_loan_extremes": _q(f"""
SELECT loan_id, user_id, ds, max(early_day) AS early_day, max(overdue_day) AS overdue_day
FROM repay_plan WHERE dt = {DAY} GROUP BY loan_id, user_id, ds"""),
    "a3_edge_stats": _q(A3),
    "a4_edge_pairs": _q("SELECT DISTINCT src, dst FROM oriented_valid"),
    "a5_distinct": _q(f"SELECT DISTINCT mobile FROM user_contact WHERE dt = {DAY}"),
    "a6_out_neighbours": _q("SELECT src AS mobile, dst AS neighbour FROM rank_pairs"),
    "a7_in_neighbours": _q("SELECT dst AS mobile, src AS neighbour FROM rank_pairs"),
    "a8_all_neighbours": _q("""
SELECT DISTINCT mobile, neighbour FROM (SELECT src AS mobile, dst AS neighbour FROM rank_pairs
                                      UNION ALL SELECT dst, src FROM rank_pairs)"""),
    "u1_merge_lists": _q(f"SELECT DISTINCT mobile FROM passed WHERE {LOAN}"),
    "u2_union_adjacency": _q("""
SELECT src AS mobile, dst AS neighbour FROM rank_pairs UNION ALL SELECT dst, src FROM rank_pairs"""),
    "x1_digits_or_zero": _q("""
SELECT call_time, CASE WHEN regexp_full_match(call_time, '[0-9]+') THEN CAST(call_time AS DOUBLE) ELSE 0.0 END
       AS duration FROM history"""),
    "x2_two_decimals": _q(f"SELECT src, dst, mean_text FROM ({A3})"),
    "x3_concat": _q(f"SELECT CAST(user_id AS VARCHAR) || ',' || ds || ',' || mobile AS line "
                    f"FROM user_contact WHERE dt = {DAY}"),
    "s4_read_delimited": _q("SELECT loan_id, ds, mobile, early_day, overdue_day FROM overdue"),
    "k1_write_lines": _q(f"SELECT mobile AS value FROM passed WHERE {WHITE}"),
    "k2_one_file": _q(f"SELECT CAST(1 AS BIGINT) AS files, count(*) AS lines FROM passed WHERE {WHITE}"),
    "p2_orient_calls_drop": _q(f"SELECT {ORIENT}, call_time FROM dirty_history "
                               "WHERE call_channel IN ('012001001', '012001002')"),
    "x4_prefixed": _q(f"SELECT user_id, 'p' || mobile AS mobile FROM user_contact WHERE dt = {DAY}"),
    "x5_clean_phone_a": _q("""
SELECT raw, CASE WHEN contains(raw, 'p0086') THEN replace(replace(raw, 'p0086', 'p'), ';cpc', '')
                 WHEN contains(raw, 'p86') THEN replace(replace(raw, 'p86', 'p'), ';cpc', '')
                 WHEN contains(raw, ';cpc') THEN replace(raw, ';cpc', '')
                 ELSE raw END AS clean
FROM dirty"""),
    "x6_clean_phone_b": _q("""
SELECT raw, CASE WHEN contains(raw, 'p0086') THEN replace(raw, 'p0086', 'p')
                 WHEN contains(raw, 'p86') THEN replace(raw, 'p86', 'p')
                 WHEN contains(raw, ';cpc') THEN replace(raw, ';cpc', '')
                 WHEN contains(raw, 'p(') THEN regexp_replace(raw, 'p\\([0-9]*\\)', 'p', 'g')
                 ELSE raw END AS clean
FROM dirty"""),
    "x7_day_of": _q(f"""
SELECT loan_id, CAST(CAST(create_time AS DATE) AS VARCHAR) AS create_day,
       CAST(CAST(due_day AS DATE) AS VARCHAR) AS due_day
FROM repay_plan WHERE dt = {DAY}"""),
    "x8_split_cast": _q("SELECT loan_id, ds, mobile, early_day, overdue_day FROM overdue"),
    "o1_order_by_score": _q(SCORES),
    "o2_order_by_text_key": _q(f"SELECT CAST(user_id AS VARCHAR) AS k, mobile FROM user_contact WHERE dt = {DAY}"),
    "k4_edge_lines": _q(f"SELECT src || ',' || dst || ',CALL_OUT,' || CAST(calls AS VARCHAR) || ',' || mean_text "
                        f"AS line FROM ({C15})"),
    "k5_pair_lines": _q("SELECT src || ',' || dst AS line FROM rank_pairs"),
    "k6_adjacency_lines": _q("SELECT src || chr(9) || string_agg(dst, chr(9) ORDER BY dst) AS line "
                             "FROM rank_pairs GROUP BY src"),
    "k7_overdue_lines": _q("""
SELECT coalesce(CAST(loan_id AS VARCHAR), '0') || ',' || coalesce(ds, 'null') || ',' || coalesce(mobile, 'null')
       || ',' || coalesce(CAST(early_day AS VARCHAR), '0') || ',' || coalesce(CAST(overdue_day AS VARCHAR), '0')
       AS line FROM overdue"""),
    "k8_score_lines": _q(f"""
SELECT CAST(score AS VARCHAR) || ',' || coalesce(CAST(overdue_day AS VARCHAR), '0') AS line FROM ({SCORES})"""),
})


def _lines(edges: str) -> str:
    return f"SELECT src || ',' || dst || ',CALL_OUT,' || CAST(calls AS VARCHAR) || ',' || mean_text FROM ({edges})"


def _parts(parts: dict[str, str]) -> str:
    return _q(" UNION ALL ".join(f"SELECT '{name}' AS folder, line FROM ({sql}) t(line)" for name, sql in parts.items()))


PAIR_LINES = "SELECT src || ',' || dst FROM rank_pairs"
ORACLE.update({
    "c27_graph_lines": _parts({
        "applyNotPass": f"""SELECT DISTINCT c.mobile FROM user_profile p JOIN day_contact c USING (user_id, ds)
WHERE p.dt = {DAY} AND p.first_apply_credit_time IS NOT NULL AND p.first_apply_credit_succ_time IS NULL""",
        "applycreditNoBorrow": f"SELECT mobile FROM passed WHERE NOT ({LOAN})",
        "borrowNotwb": f"SELECT mobile FROM passed WHERE {GREY}",
        "whitelist": f"SELECT mobile FROM passed WHERE {WHITE}",
        "blacklist": f"SELECT mobile FROM passed WHERE {BLACK}",
        "relationship": _lines(C15_TODAY)}),
    "c28_ranking_lines": _parts({
        "whitelist": f"SELECT mobile FROM passed WHERE {WHITE}",
        "blacklist": f"""SELECT mobile FROM passed WHERE {BLACK} UNION SELECT mobile FROM fraud WHERE mobile IS NOT NULL
UNION SELECT mobile FROM third_party_blacklist WHERE dt = {DAY}""",
        "relationship": PAIR_LINES,
        "onedegree": "SELECT src || chr(9) || string_agg(dst, chr(9) ORDER BY dst) FROM rank_pairs GROUP BY src"}),
    "c29_snapshot_lines": _parts({
        "whitelist": f"SELECT mobile FROM passed WHERE {WHITE} AND coalesce(max_prepayment_day_cnt, 0) <= 3",
        "blacklist": f"SELECT mobile FROM passed WHERE {LOAN} AND {OD} >= 7",
        "relationship": PAIR_LINES}),
    "c30_call_graph_lines": _parts({
        "relationship": _lines(C15),
        "person": f"SELECT src FROM ({C15}) UNION SELECT dst FROM ({C15})"}),
})


def oracle() -> dict[str, str]:
    return dict(ORACLE)
