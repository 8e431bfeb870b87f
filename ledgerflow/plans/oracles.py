"""The queries as SQL for DuckDB, composed of named parts. The rules, word lists and codes are written out here on their
own, so that a slip in the engine's tables does not repeat itself."""

from __future__ import annotations

import re

_EMP_NORM = r"regexp_replace(regexp_replace(trim(upper({0})), '[,.]', '', 'g'), '\s+', ' ', 'g')"
_NAME_NORM = r"regexp_replace(regexp_replace(trim(upper({0})), '\s*,\s*', ' ', 'g'), '\s+', ' ', 'g')"
_DONOR_KEY = f"substr(sha256({_NAME_NORM.format('NAME')} || '|' || {_EMP_NORM.format('emp')}), 1, 16)"
_EMP_KEY = f"substr(sha256({_EMP_NORM.format('canonical_employer')}), 1, 16)"
_COMPANY = """upper(trim(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(CMTE_NM,
  ' POLITICAL ACTION COMMITTEE', ''), ' PAC', ''), ' EMPLOYEE FEDERAL POLITICAL ACTION COMMITTEE', ''), ' EMPLOYEES POLITICAL ACTION COMMITTEE', ''),
  ' GOOD GOVERNMENT FUND', ''), ' EMPLOYEES'' PAC', ''), ', INC.', ''), ' INC.', ''), ' LLC', ''), ' CORPORATION', ''), ' CORP', ''), ' COMPANY', ''), ' CO.', ''),
  ' EMPLOYEES OF', ''), ' EMPLOYEES', '')))"""
_TERMINAL = "('corporation', 'labor_union', 'trade_association', 'cooperative', 'ideological')"
_CONDUIT_NAME = "(contains(upper({0}), 'WINRED') OR contains(upper({0}), 'ACTBLUE') OR contains(upper({0}), 'EARMARK') OR contains(upper({0}), 'CONDUIT') OR contains(upper({0}), 'UNITEMIZED'))"
_CMTE_TP = "(['H', 'S', 'P', 'N', 'Q', 'W', 'O', 'U', 'X', 'Y', 'V', 'D', 'N'])"
_ORG_TP = "(['C', 'L', 'T', 'M', 'V', 'W', ''])"
_ENTITY = "(['COM', 'PAC', 'PTY', 'CCM', 'ORG', 'IND'])"
_CYCLE = "'1998'"
_PART = "CAST({0} AS DECIMAL(20,4)) * CAST(round({1}, 12) AS DECIMAL(18,12))"



def _attributed(levels: list[str], dust: str = "0.01", kind: str = "kind") -> str:
    found = " UNION ALL ".join(
        f"SELECT start, {kind} AS kind, donor_key AS entity, {_PART.format('w', 'm')} AS a FROM {f} JOIN inflow USING (cmte_id) UNION ALL "
        f"SELECT start, src_type, src, {_PART.format('w', 'm')} FROM {f} JOIN weights ON cmte_id = dst WHERE src_type IN {_TERMINAL}"
        for f in levels
    )
    return f"SELECT start, kind, entity, sum(a) AS amount FROM ({found}) GROUP BY start, kind, entity HAVING sum(a) > {dust}"


PARTS = {
    "ord": "SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) + year(o_orderdate) % 2 AS VARCHAR) AS cycle FROM orders",
    "joined": f"""
        SELECT o.cycle, l.l_orderkey, l.l_suppkey, l.l_linenumber, l.l_returnflag, CAST(l.l_extendedprice AS DECIMAL(14,2)) AS price, c.*,
          'C' || lpad(CAST(l_suppkey AS VARCHAR), 8, '0') AS CMTE_ID
        FROM lineitem l JOIN ord o ON l_orderkey = o_orderkey JOIN customer c ON o_custkey = c_custkey""",
    "indiv": f"""
        SELECT cycle, CMTE_ID, CASE c_custkey % 7 WHEN 0 THEN c_name WHEN 1 THEN c_name || ' LLC' WHEN 2 THEN 'ACTBLUE ' || c_custkey
            WHEN 3 THEN 'DOE ' || c_custkey || ', JANE' WHEN 4 THEN 'MR ' || c_name WHEN 5 THEN 'SMITH  JOHN ' || c_custkey
            ELSE 'UNITEMIZED ' || c_custkey END AS NAME,
          CASE c_custkey % 11 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'RETIRED' WHEN 3 THEN c_mktsegment || ', INC.' ELSE c_mktsegment END AS EMPLOYER,
          CAST(price * CAST((['0.01', '0.03', '0.10', '0.30', '1.00'])[CAST(c_custkey % 5 + 1 AS INTEGER)] AS DECIMAL(3,2)) AS DECIMAL(18,4)) AS amt
        FROM joined""",
    "cm": f"""
        SELECT 'C' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS CMTE_ID,
          CASE s_suppkey % 3 WHEN 0 THEN s_name || ' EMPLOYEES PAC' WHEN 1 THEN s_name || ' CORPORATION' ELSE s_name END AS CMTE_NM,
          {_CMTE_TP}[CAST(s_suppkey % 13 + 1 AS INTEGER)] AS CMTE_TP, {_ORG_TP}[CAST(s_suppkey % 7 + 1 AS INTEGER)] AS ORG_TP
        FROM supplier""",
    "cn": """
        SELECT 'H' || lpad(CAST(n_nationkey AS VARCHAR), 8, '0') AS CAND_ID, n_name AS CAND_NAME,
          (['DEM', 'REP', 'D', 'R', 'IND'])[CAST(n_regionkey % 5 + 1 AS INTEGER)] AS CAND_PTY_AFFILIATION,
          (['H', 'S', 'P'])[CAST(n_nationkey % 3 + 1 AS INTEGER)] AS CAND_OFFICE
        FROM nation""",
    "affiliated": f"""
        SELECT DISTINCT 'C' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS cmte_id, 'H' || lpad(CAST(s_nationkey AS VARCHAR), 8, '0') AS cand_id, cycle,
          CAST(s_suppkey * 10000 + CAST(cycle AS BIGINT) AS VARCHAR) AS linkage_id, (['P', 'A', 'J', 'U'])[CAST(s_suppkey % 4 + 1 AS INTEGER)] AS cmte_designation,
          {_CMTE_TP}[CAST(s_suppkey % 13 + 1 AS INTEGER)] AS cmte_type
        FROM joined JOIN supplier ON l_suppkey = s_suppkey WHERE s_nationkey IN (SELECT n_nationkey FROM nation)""",
    "spent": """
        SELECT CMTE_ID AS cmte_id, 'H' || lpad(CAST(c_nationkey AS VARCHAR), 8, '0') AS cand_id, CASE l_returnflag WHEN 'R' THEN 'S' ELSE 'O' END AS support_oppose,
          cycle, sum(price) AS total_amount, count(*) AS transaction_count
        FROM joined WHERE l_returnflag IN ('A', 'R') AND CMTE_ID IN (SELECT CMTE_ID FROM cm)
        GROUP BY ALL HAVING sum(price) > 0""",
    "moves": f"""
        SELECT * FROM (
          SELECT l_orderkey, cycle, 'C' || lpad(CAST(lag(l_suppkey) OVER w AS VARCHAR), 8, '0') AS src, 'C' || lpad(CAST(l_suppkey AS VARCHAR), 8, '0') AS dst,
            {_ENTITY}[CAST(lag(l_suppkey) OVER w % 6 + 1 AS INTEGER)] AS entity, amt
          FROM (SELECT l_orderkey, cycle, l_suppkey, min(l_linenumber) AS ln, sum(CAST(l_extendedprice AS DECIMAL(14,2))) AS amt
                FROM lineitem JOIN ord ON l_orderkey = o_orderkey GROUP BY ALL)
          WINDOW w AS (PARTITION BY l_orderkey ORDER BY ln, l_suppkey))
        WHERE src IS NOT NULL""",
    "transferred": """
        SELECT src, dst, cycle, CASE WHEN l_orderkey % 3 = 0 THEN 'oth' ELSE 'pas2' END AS source, sum(amt) AS total_amount, count(*) AS transaction_count
        FROM moves
        WHERE src <> dst AND CASE WHEN l_orderkey % 3 = 0 THEN entity IN ('PAC', 'COM', 'PTY', 'ORG') ELSE entity IN ('COM', 'PAC', 'PTY', 'CCM', 'ORG') END
          AND src IN (SELECT CMTE_ID FROM cm) AND dst IN (SELECT CMTE_ID FROM cm)
        GROUP BY ALL HAVING sum(amt) > 0""",
    "gifts": "SELECT cycle, CMTE_ID, NAME, EMPLOYER, CASE WHEN coalesce(EMPLOYER, '') = '' THEN 'NOT EMPLOYED' ELSE EMPLOYER END AS emp, amt FROM indiv WHERE NAME <> ''",
    "donor_groups": f"SELECT cycle, NAME, emp, sum(amt) AS t, count(*) AS n, {_DONOR_KEY} AS donor_key FROM gifts GROUP BY cycle, NAME, emp HAVING sum(amt) >= 10000",
    "donors0": """
        SELECT donor_key, min(NAME) AS canonical_name, min(emp) AS canonical_employer, sum(t) AS total_amount, CAST(sum(n) AS BIGINT) AS transaction_count,
          string_agg(DISTINCT cycle, ',' ORDER BY cycle) AS cycles
        FROM donor_groups GROUP BY donor_key""",
    "donors": r"""
        SELECT *, CASE WHEN canonical_name = '' THEN 'unclear' WHEN regexp_matches(upper(canonical_name), '^WINRED|^ACTBLUE|EARMARK|CONDUIT') THEN 'conduit'
            WHEN regexp_matches(upper(canonical_name), '\b(INC|LLC|LLP|CORP|CORPORATION|CO\.?|COMPANY|LIMITED|LTD)\b')
              OR regexp_matches(upper(canonical_name), '\b(PAC|COMMITTEE|FUND|FOUNDATION|TRUST|ASSOCIATION|SOCIETY)\b')
              OR regexp_matches(upper(canonical_name), '\b(PARTNERS|GROUP|HOLDINGS|CAPITAL|VENTURES|MANAGEMENT)\b')
              OR regexp_matches(upper(canonical_name), '\b(UNION|COUNCIL|FEDERATION|COALITION|ALLIANCE)\b') THEN 'organization'
            WHEN regexp_matches(upper(canonical_name), '\b(MR|MRS|MS|DR|MD|PHD|JR|SR|III|IV)\b') OR regexp_matches(upper(canonical_name), '^[A-Z]+\s+[A-Z]+$')
              OR regexp_matches(upper(canonical_name), ',\s*[A-Z]+$')
              OR regexp_matches(upper(canonical_employer), '\b(SELF[\s-]EMPLOYED|RETIRED|NOT EMPLOYED|UNEMPLOYED|N/A|NONE)\b') THEN 'individual'
            WHEN contains(canonical_name, ',') OR len(string_split(canonical_name, ' ')) >= 2 THEN 'likely_individual' ELSE 'unclear' END AS donor_type,
          CASE WHEN total_amount >= 1000000 THEN 'ultra' WHEN total_amount >= 500000 THEN 'mega' WHEN total_amount >= 100000 THEN 'whale'
            WHEN total_amount >= 50000 THEN 'notable' END AS whale_tier
        FROM donors0""",
    "real": f"SELECT *, {_EMP_KEY} AS employer_key FROM donors0 WHERE canonical_employer <> '' AND canonical_employer NOT IN ('NOT EMPLOYED', 'SELF-EMPLOYED', 'SELF EMPLOYED', 'RETIRED', 'NONE', 'N/A')",
    "employers": """
        SELECT employer_key, min(canonical_employer) AS name, sum(total_amount) AS total_from_employees, count(*) AS employee_donor_count,
          CAST(sum(transaction_count) AS BIGINT) AS total_transactions FROM real GROUP BY employer_key""",
    "contrib_groups": f"SELECT cycle, NAME, emp, CMTE_ID, sum(amt) AS t, count(*) AS n, {_DONOR_KEY} AS donor_key FROM gifts GROUP BY cycle, NAME, emp, CMTE_ID HAVING sum(amt) > 0",
    "contributed": """
        SELECT donor_key, CMTE_ID AS cmte_id, cycle, sum(t) AS total_amount, CAST(sum(n) AS BIGINT) AS transaction_count FROM contrib_groups
        WHERE donor_key IN (SELECT donor_key FROM donors0) AND CMTE_ID IN (SELECT CMTE_ID FROM cm) GROUP BY ALL""",
    "typed": """
        SELECT *, CASE WHEN CMTE_TP IN ('X', 'Y', 'Z', 'V') THEN 'passthrough' WHEN CMTE_TP IN ('H', 'S', 'P') THEN 'campaign' WHEN ORG_TP = 'C' THEN 'corporation'
            WHEN ORG_TP = 'T' THEN 'trade_association' WHEN ORG_TP = 'L' THEN 'labor_union' WHEN ORG_TP = 'M' THEN 'ideological' WHEN ORG_TP = 'W' THEN 'corporation'
            WHEN ORG_TP = 'V' THEN 'cooperative' WHEN CMTE_TP IN ('O', 'U') THEN 'super_pac_unclassified' WHEN CMTE_TP IN ('N', 'Q', 'W') THEN 'passthrough'
            ELSE 'unknown' END AS terminal_type FROM cm""",
    "committees": """
        SELECT t.*, coalesce((SELECT sum(total_amount) FROM contributed c WHERE c.cmte_id = t.CMTE_ID), 0)
            + coalesce((SELECT sum(total_amount) FROM transferred x WHERE x.dst = t.CMTE_ID), 0) AS total_receipts,
          coalesce((SELECT sum(total_amount) FROM transferred x WHERE x.src = t.CMTE_ID), 0) AS total_disbursed
        FROM typed t""",
    "starts": """
        SELECT cand_id AS start, cmte_id FROM (
          SELECT DISTINCT a.cand_id, a.cmte_id, t.CMTE_TP IN ('H', 'S', 'P') AS c FROM affiliated a JOIN typed t ON a.cmte_id = t.CMTE_ID)
        QUALIFY c OR NOT bool_or(c) OVER (PARTITION BY cand_id)""",
    "all_starts": "SELECT DISTINCT cand_id AS start, cmte_id FROM affiliated",
    "pairs": "SELECT src, dst, CAST(sum(total_amount) AS DECIMAL(18,4)) AS w FROM transferred GROUP BY src, dst",
    "weights": "SELECT p.*, c.terminal_type AS src_type, CAST(c.total_receipts AS DOUBLE) AS r FROM pairs p JOIN committees c ON p.src = c.CMTE_ID",
    "inflow": f"""
        SELECT c.cmte_id, c.donor_key, CASE WHEN any_value(d.donor_type) = 'organization' THEN 'dark_money' ELSE 'individual' END AS kind, CAST(sum(c.total_amount) AS DECIMAL(18,4)) AS w
        FROM contributed c JOIN donors d USING (donor_key) WHERE NOT {_CONDUIT_NAME.format('d.canonical_name')} GROUP BY c.cmte_id, c.donor_key""",
    "f0": "SELECT start, cmte_id, CAST(1.0 AS DOUBLE) AS m FROM starts",
    **{
        f"f{k}": f"""
        SELECT start, src AS cmte_id, sum(m * (CAST(w AS DOUBLE) / r)) AS m FROM f{k - 1} JOIN weights ON cmte_id = dst
        WHERE src_type IN ('passthrough', 'unknown') AND r > 0 GROUP BY start, src HAVING sum(m * (CAST(w AS DOUBLE) / r)) >= 1e-4"""
        for k in range(1, 5)
    },
    # one visit of a node: the parent with the largest share counts; a node is seen whether or not its share is large enough to go on
    **{
        f"v{k}{s}": f"""
        SELECT start, cmte_id, m FROM (
          SELECT f.start, x.src AS cmte_id, f.m * (CAST(x.w AS DOUBLE) / x.r) AS m,
            row_number() OVER (PARTITION BY f.start, x.src ORDER BY f.m DESC, x.dst, f.m * (CAST(x.w AS DOUBLE) / x.r) DESC) AS rn
          FROM v{k - 1}{s} f JOIN weights x ON f.cmte_id = x.dst WHERE x.src_type IN ('passthrough', 'unknown') AND x.r > 0 AND f.m >= {least})
        WHERE rn = 1 AND (start, cmte_id) NOT IN ({" UNION ALL ".join(f"SELECT (start, cmte_id) FROM v{j}{s}" for j in range(k))})"""
        for s, least in (("", "1e-4"), ("d", "1e-3"))
        for k in range(1, 5)
    },
    "v0": "SELECT start, cmte_id, CAST(1.0 AS DOUBLE) AS m FROM starts",
    "v0d": "SELECT start, cmte_id, CAST(1.0 AS DOUBLE) AS m FROM starts",
    "attributed": _attributed([f"f{k}" for k in range(5)]),
    "attributed_v": _attributed([f"(SELECT * FROM v{k} WHERE m >= 1e-4)" for k in range(5)]),
    "attributed_d": _attributed([f"(SELECT * FROM v{k}d WHERE m >= 1e-3)" for k in range(4)], "0", "'individual'"),
    "gift1": f"""
        SELECT c.cmte_id, c.donor_key AS entity, 'donor' AS terminal_type, d.canonical_name AS name, CAST(c.total_amount AS DECIMAL(20,4)) AS amount
        FROM contributed c JOIN donors0 d USING (donor_key) WHERE NOT {_CONDUIT_NAME.format('d.canonical_name')}""",
    "move1": "SELECT x.dst AS cmte_id, x.src AS entity, t.terminal_type, t.CMTE_NM AS name, CAST(x.total_amount AS DECIMAL(20,4)) AS amount FROM transferred x JOIN typed t ON x.src = t.CMTE_ID",
    "unweighted": f"""
        SELECT start, entity, terminal_type, name, sum(amount) AS total_amount, CAST(sum(n) AS BIGINT) AS paths FROM (
          SELECT start, g.entity, terminal_type, name, amount, 1 AS n FROM all_starts JOIN gift1 g USING (cmte_id)
          UNION ALL SELECT start, m.entity, terminal_type, name, amount, 1 FROM all_starts JOIN move1 m USING (cmte_id) WHERE terminal_type IN {_TERMINAL}
          UNION ALL SELECT p.start, f.entity, f.terminal_type, f.name, f.amount * p.k, f.n * p.k
            FROM (SELECT start, entity AS cmte_id, count(*) AS k FROM all_starts JOIN move1 USING (cmte_id) WHERE terminal_type IN ('passthrough', 'unknown') GROUP BY ALL) p
            JOIN (SELECT cmte_id, entity, terminal_type, name, sum(amount) AS amount, count(*) AS n
                  FROM (SELECT * FROM gift1 UNION ALL SELECT * FROM move1 WHERE terminal_type IN {_TERMINAL}) GROUP BY ALL) f USING (cmte_id))
        GROUP BY start, entity, terminal_type, name""",
    "persons": "SELECT cmte_id, CAST(sum(c.total_amount) AS DOUBLE) AS own, sum(c.total_amount) AS individuals, count(DISTINCT donor_key) AS n_donors FROM contributed c JOIN donors d USING (donor_key) WHERE d.donor_type IS DISTINCT FROM 'conduit' GROUP BY cmte_id",
    "rbase": f"SELECT committees.CMTE_ID AS cmte_id, terminal_type IN {_TERMINAL} AS org, total_receipts > 0 AS paid, coalesce(own, 0.0) AS own FROM committees LEFT JOIN persons ON committees.CMTE_ID = persons.cmte_id",
    "r0": "SELECT cmte_id, org, CASE WHEN org THEN 0.0::DOUBLE ELSE 0.5 END AS i, CASE WHEN org THEN 1.0::DOUBLE ELSE 0.5 END AS o, CASE WHEN org THEN 0.0::DOUBLE ELSE 1.0 END AS h FROM rbase",
    **{
        f"r{k}": f"""
        SELECT cmte_id, org, CASE WHEN org THEN 0.0 WHEN NOT paid OR own + si + so <= 0 THEN 0.5 ELSE (own + si) / ((own + si) + so) END AS i,
          CASE WHEN org THEN 1.0 WHEN NOT paid OR own + si + so <= 0 THEN 0.5 ELSE so / ((own + si) + so) END AS o,
          CASE WHEN org THEN 0.0 WHEN NOT paid OR own + si + so <= 0 THEN 1.0 ELSE (own + sh) / (own + sw) END AS h
        FROM (SELECT b.*, coalesce(si, 0.0) AS si, coalesce(so, 0.0) AS so, coalesce(sh, 0.0) AS sh, coalesce(sw, 0.0) AS sw FROM rbase b LEFT JOIN (
          SELECT dst AS cmte_id, sum(w * i) AS si, sum(w * o) AS so, sum(w * CASE WHEN org THEN 1.0 ELSE h + 1 END) AS sh, sum(w) AS sw
          FROM (SELECT src, dst, CAST(w AS DOUBLE) AS w FROM pairs) JOIN r{k - 1} s ON src = s.cmte_id GROUP BY dst) USING (cmte_id))"""
        for k in range(1, 10)
    },
    "links": "SELECT DISTINCT cmte_id, cand_id FROM affiliated",
    "lean": """
        SELECT donor_key, dem, rep, total - dem - rep AS other, total, CASE WHEN total <= 0 THEN 'UNKNOWN' WHEN dem > 1.5 * rep THEN 'DEM' WHEN rep > 1.5 * dem THEN 'REP' ELSE 'MIXED' END AS lean
        FROM (SELECT donor_key, coalesce(sum(total_amount) FILTER (CAND_PTY_AFFILIATION IN ('DEM', 'D')), 0) AS dem,
            coalesce(sum(total_amount) FILTER (CAND_PTY_AFFILIATION IN ('REP', 'R')), 0) AS rep, sum(total_amount) AS total
          FROM contributed JOIN links USING (cmte_id) JOIN cn ON links.cand_id = cn.CAND_ID WHERE CAND_PTY_AFFILIATION IS NOT NULL GROUP BY donor_key)""",
    "edges": "SELECT DISTINCT src, dst FROM transferred WHERE src <> dst",
    "chain0": "SELECT DISTINCT cand_id, cmte_id AS node, CAST(1 AS HUGEINT) AS walks FROM affiliated",
    **{f"chain{k}": f"SELECT cand_id, src AS node, sum(walks) AS walks FROM chain{k - 1} JOIN edges ON node = dst GROUP BY ALL" for k in range(1, 6)},
    "came": """
        SELECT cmte_id, kind, sum(w) AS w FROM (
          SELECT c.cmte_id, coalesce(d.donor_type, 'donor') AS kind, sum(c.total_amount) AS w FROM contributed c JOIN donors d USING (donor_key) GROUP BY ALL
          UNION ALL SELECT dst, src_type, sum(w) FROM weights GROUP BY ALL) GROUP BY ALL""",
    "share1": "SELECT DISTINCT cmte_id AS target, cmte_id, CAST(1.0 AS DOUBLE) AS m FROM came",
    **{f"share{k}": f"SELECT target, src AS cmte_id, sum(m * (CAST(w AS DOUBLE) / r)) AS m FROM share{k - 1} JOIN weights ON cmte_id = dst WHERE r > 0 GROUP BY ALL" for k in (2, 3)},
    "hop_levels": """
        SELECT origin, target, hops FROM (WITH RECURSIVE level AS (
          SELECT src AS origin, dst AS target, CAST(1 AS BIGINT) AS hops FROM edges
          UNION SELECT origin, dst, hops + 1 FROM level JOIN edges ON target = src WHERE origin <> dst AND hops < (SELECT count(*) FROM cm)) SELECT * FROM level)""",
    "members": """
        SELECT 'B' || substr(CAND_ID, 2) AS bioguide, k, CAND_ID, CAND_PTY_AFFILIATION AS party, 'First' || k % 5 AS first, 'Last' || k AS last, k % 4 <> 3 AS known
        FROM (SELECT *, CAST(substr(CAND_ID, 2) AS INTEGER) AS k FROM cn)""",
    "mapping": """
        SELECT m.bioguide, m.first, m.last, CASE WHEN known THEN m.CAND_ID ELSE '' END AS candidate_ids, coalesce(string_agg(DISTINCT a.cmte_id, ',' ORDER BY a.cmte_id), '') AS committee_ids,
          CASE WHEN k % 2 = 0 THEN 'senate' ELSE 'house' END AS chamber, lpad(CAST(k % 50 AS VARCHAR), 2, '0') AS state, party
        FROM members m LEFT JOIN linked a ON m.known AND a.cand_id = m.CAND_ID GROUP BY ALL""",
    "linked": "SELECT DISTINCT 'H' || lpad(CAST(s_nationkey AS VARCHAR), 8, '0') AS cand_id, CMTE_ID AS cmte_id FROM joined JOIN supplier ON l_suppkey = s_suppkey",
}


def _cents(x: str) -> str:
    return f"CAST(round({x}, 2) AS DOUBLE)"


def _by_cycle(entity: str, flows: dict[str, str]) -> str:
    """flows: name -> rows (entity, cycle, total_amount)."""
    rows = " UNION ALL ".join(
        f"SELECT e, cycle, {', '.join(f'CASE WHEN {n == m!s} THEN CAST(total_amount AS DECIMAL(20,4)) END AS {m}' for m in flows)} FROM ({sql})".replace("CASE WHEN True", "CASE WHEN TRUE").replace("CASE WHEN False", "CASE WHEN FALSE")
        for n, sql in flows.items()
    )
    cols = ", ".join(f"CAST(coalesce(sum({n}), 0) AS DOUBLE) AS {n}, count({n}) AS {n}_count" for n in flows)
    return f"""
        WITH flow AS ({rows})
        SELECT g.e AS {entity}, g.cycle, {cols} FROM (SELECT * FROM (SELECT DISTINCT e FROM flow) CROSS JOIN (SELECT unnest(['1996', '1998', '2000', '2002']) AS cycle)) g
        LEFT JOIN flow f ON f.e = g.e AND f.cycle = g.cycle GROUP BY g.e, g.cycle"""


def _top(by: str, other: str, table: str) -> str:
    return f"(SELECT {by}, {other}, sum(total_amount) AS a, row_number() OVER (PARTITION BY {by} ORDER BY sum(total_amount) DESC, {other}) AS rank FROM {table} GROUP BY {by}, {other})"


def _ie(side: str) -> str:
    return f"""
        SELECT cand_id, kind, label, {_cents("sum(" + _PART.format("w", "m") + ")")} AS amount FROM (
          SELECT cand_id, s.cmte_id, CAST(sum(s.total_amount) AS DOUBLE) / CAST(any_value(c.total_receipts) AS DOUBLE) AS m
          FROM spent s JOIN committees c ON s.cmte_id = c.CMTE_ID WHERE support_oppose = '{side}' AND c.total_receipts > 0 GROUP BY cand_id, s.cmte_id)
        JOIN (
          SELECT cmte_id, kind, CASE WHEN kind = 'individual' AND coalesce(canonical_employer, '') <> ''
                AND upper(canonical_employer) NOT IN ('RETIRED', 'SELF', 'SELF-EMPLOYED', 'NOT EMPLOYED', 'NONE', 'N/A', 'HOMEMAKER')
              THEN canonical_name || ' (' || canonical_employer || ')' ELSE canonical_name END AS label, sum(w) AS w
            FROM inflow JOIN donors USING (donor_key) GROUP BY ALL
          UNION ALL SELECT dst, terminal_type, CMTE_NM, sum(w) FROM pairs JOIN typed ON src = CMTE_ID GROUP BY ALL) USING (cmte_id)
        GROUP BY cand_id, kind, label HAVING sum({_PART.format("w", "m")}) > 0.01"""


_ONE = _PART.format("{0}", "1.0::DOUBLE")
_CORPORATE = f"""
        SELECT start, company, {_cents('sum(pac)')} AS pac, {_cents('sum(emp)')} AS employees, {_cents('sum(pac) + sum(emp)')} AS total FROM (
          SELECT start, {_COMPANY} AS company, {_PART.format('w', 'pct')} AS pac, CAST(0 AS DECIMAL(37,16)) AS emp FROM (
            SELECT s.start, p.src AS via, least(CAST(sum(p.w) AS DOUBLE) / CAST(any_value(t.t) AS DOUBLE), 1.0) AS pct FROM starts s JOIN pairs p ON s.cmte_id = p.dst
              JOIN typed c ON p.src = c.CMTE_ID AND c.terminal_type = 'passthrough' JOIN (SELECT src, sum(w) AS t FROM pairs GROUP BY src) t ON t.src = p.src
            GROUP BY s.start, p.src HAVING sum(p.w) > 0)
            JOIN pairs ON via = dst JOIN typed ON src = CMTE_ID AND ORG_TP = 'C'
          UNION ALL SELECT start, {_COMPANY}, {_ONE.format('w')}, 0 FROM starts JOIN pairs ON cmte_id = dst JOIN typed ON src = typed.CMTE_ID AND ORG_TP = 'C'
          UNION ALL SELECT start, trim(upper(canonical_employer)), 0, {_ONE.format('total_amount')}
            FROM starts JOIN (SELECT cmte_id, donor_key, sum(total_amount) AS total_amount FROM contributed GROUP BY ALL) USING (cmte_id)
            JOIN (SELECT donor_key, donor_type, canonical_employer FROM donors) USING (donor_key)
            WHERE donor_type IN ('individual', 'likely_individual') AND canonical_employer NOT IN ('RETIRED', 'SELF', 'SELF-EMPLOYED', 'NOT EMPLOYED', 'NONE', 'N/A',
              'HOMEMAKER', 'SELF EMPLOYED', 'NA', 'UNEMPLOYED', 'OWNER', 'INVESTOR', 'BUSINESS OWNER', ''))
        GROUP BY start, company"""
_TOTALS = """
        SELECT start, direct, pac, ie_support, ie_oppose, direct + pac + ie_support AS pro FROM (
          SELECT start, CAST(coalesce(sum(a) FILTER (p = 'd'), 0) AS DOUBLE) AS direct, CAST(coalesce(sum(a) FILTER (p = 'p'), 0) AS DOUBLE) AS pac,
            CAST(coalesce(sum(a) FILTER (p = 'S'), 0) AS DOUBLE) AS ie_support, CAST(coalesce(sum(a) FILTER (p = 'O'), 0) AS DOUBLE) AS ie_oppose FROM (
            SELECT start, 'd' AS p, CAST(total_amount AS DECIMAL(20,4)) AS a FROM {0} JOIN contributed USING (cmte_id)
            UNION ALL SELECT start, 'p', CAST(total_amount AS DECIMAL(20,4)) FROM {0} JOIN transferred ON cmte_id = dst
            UNION ALL SELECT cand_id, support_oppose, CAST(total_amount AS DECIMAL(20,4)) FROM spent) GROUP BY start)"""
_LEAN_PCT = ", ".join(f"CASE WHEN total > 0 THEN round(CAST({p} AS DOUBLE) / CAST(total AS DOUBLE) * 100, 1) ELSE 0.0 END AS {p}_pct" for p in ("dem", "rep", "other"))
_EDGES = "src, dst, cycle, source, CAST(total_amount AS DOUBLE) AS total_amount, transaction_count"
_CATEGORY = """CASE terminal_type WHEN 'corporation' THEN 'corporations' WHEN 'trade_association' THEN 'trade_associations' WHEN 'labor_union' THEN 'labor_unions'
  WHEN 'ideological' THEN 'ideological' WHEN 'donor' THEN 'donors' ELSE 'unresolved' END"""

BODIES = {
    "contrib_edges": "SELECT donor_key, cmte_id, cycle, CAST(total_amount AS DOUBLE) AS total_amount, transaction_count FROM contributed",
    "donor_vertices": "SELECT donor_key, canonical_name, canonical_employer, CAST(total_amount AS DOUBLE) AS total_amount, transaction_count, cycles FROM donors0",
    "donor_keys": f"""
        SELECT DISTINCT NAME, EMPLOYER, {_NAME_NORM.format('NAME')} AS norm_name, {_EMP_NORM.format('emp')} AS norm_employer, {_DONOR_KEY} AS donor_key,
          {_CONDUIT_NAME.format('NAME')} AS conduit_name FROM gifts""",
    "employer_vertices": "SELECT employer_key, name, CAST(total_from_employees AS DOUBLE) AS total_from_employees, employee_donor_count, total_transactions FROM employers",
    "employed_by_edges": "SELECT donor_key, employer_key FROM real",
    "transfer_edges": f"SELECT {_EDGES} FROM transferred",
    "ie_edges": "SELECT cmte_id, cand_id, support_oppose, cycle, CAST(total_amount AS DOUBLE) AS total_amount, transaction_count FROM spent",
    "affiliation_edges": "SELECT * FROM affiliated",
    "committee_terminal_type": "SELECT CMTE_ID, CMTE_TP, ORG_TP, terminal_type FROM typed",
    "committee_flags": f"SELECT CMTE_ID, CMTE_TP IN ('I', 'O', 'U') AS is_super_pac, CMTE_TP IN ('H', 'S', 'P') AS is_campaign, {_COMPANY} AS company FROM cm",
    "candidate_names": """
        SELECT CAND_ID, CAND_NAME, CASE CAND_OFFICE WHEN 'H' THEN 'House' WHEN 'S' THEN 'Senate' WHEN 'P' THEN 'President' ELSE 'Unknown' END AS office,
          CASE CAND_PTY_AFFILIATION WHEN 'REP' THEN 'Republican' WHEN 'DEM' THEN 'Democrat' WHEN 'LIB' THEN 'Libertarian' WHEN 'GRE' THEN 'Green' WHEN 'IND' THEN 'Independent'
            ELSE CASE WHEN coalesce(CAND_PTY_AFFILIATION, '') = '' THEN 'Unknown' ELSE CAND_PTY_AFFILIATION END END AS party FROM cn""",
    "linkage_flags": "SELECT cand_id, count(*) FILTER (cmte_designation = 'P') AS principal, count(*) FILTER (cmte_designation IN ('P', 'A')) AS authorized, count(*) AS links FROM affiliated GROUP BY cand_id",
    "donor_type": "SELECT donor_key, canonical_name, canonical_employer, donor_type FROM donors",
    "whale_tier": "SELECT donor_key, CAST(total_amount AS DOUBLE) AS total_amount, whale_tier FROM donors",
    "type_counts": "SELECT donor_type, whale_tier, count(*) AS n FROM donors GROUP BY ALL",
    "committee_financials": "SELECT CMTE_ID, CAST(total_receipts AS DOUBLE) AS total_receipts, CAST(total_disbursed AS DOUBLE) AS total_disbursed FROM committees",
    "largest_committees": "SELECT CMTE_ID, CMTE_NM, CAST(total_receipts AS DOUBLE) AS total_receipts FROM committees ORDER BY committees.total_receipts DESC, CMTE_ID LIMIT 5",
    "financial_stats": "SELECT count(*) AS committees, count(*) FILTER (total_receipts > 0) AS with_receipts, count(*) FILTER (total_disbursed > 0) AS with_disbursed, count(*) FILTER (total_receipts > 0 AND total_disbursed > 0) AS with_both FROM committees",
    "committee_by_cycle": _by_cycle("cmte_id", {"individual": "SELECT cmte_id AS e, cycle, total_amount FROM contributed", "committee": "SELECT dst AS e, cycle, total_amount FROM transferred"}),
    "donor_by_cycle": _by_cycle("donor_key", {"total": "SELECT donor_key AS e, cycle, total_amount FROM contributed"}),
    "top_donors": f"""
        SELECT cmte_id, t.donor_key, CAST(a AS DOUBLE) AS amount, CAST(rank AS INTEGER) AS rank, canonical_name, donor_type, whale_tier
        FROM {_top('cmte_id', 'donor_key', "(SELECT * FROM contributed JOIN (SELECT donor_key FROM donors WHERE donor_type IS DISTINCT FROM 'conduit') USING (donor_key))")} t
        JOIN (SELECT donor_key, canonical_name, donor_type, whale_tier FROM donors) USING (donor_key) WHERE rank <= 10""",
    "donor_top_committees": f"""
        SELECT donor_key, t.cmte_id, CAST(a AS DOUBLE) AS amount, CAST(rank AS INTEGER) AS rank, CMTE_NM, terminal_type
        FROM {_top('donor_key', 'cmte_id', 'contributed')} t JOIN typed ON t.cmte_id = typed.CMTE_ID WHERE rank <= 10""",
    "candidate_top_donors": f"""
        SELECT start, t.donor_key, CAST(a AS DOUBLE) AS amount, CAST(rank AS INTEGER) AS rank, canonical_name, donor_type, whale_tier
        FROM {_top('start', 'donor_key', "(SELECT * FROM all_starts JOIN contributed USING (cmte_id) JOIN (SELECT donor_key FROM donors WHERE donor_type IS DISTINCT FROM 'conduit') USING (donor_key))")} t
        JOIN (SELECT donor_key, canonical_name, donor_type, whale_tier FROM donors) USING (donor_key) WHERE rank <= 10""",
    "candidate_top_committees": f"""
        SELECT start, src, CAST(a AS DOUBLE) AS amount, CAST(rank AS INTEGER) AS rank, CMTE_NM, terminal_type
        FROM {_top('start', 'src', '(SELECT * FROM all_starts JOIN transferred ON cmte_id = dst)')} JOIN typed ON src = CMTE_ID WHERE rank <= 10""",
    "candidate_whale_counts": """
        SELECT start, whale_tier, count(*) AS n_edges, count(DISTINCT donor_key) AS n_donors
        FROM all_starts JOIN contributed USING (cmte_id) JOIN (SELECT donor_key, whale_tier FROM donors WHERE whale_tier IS NOT NULL) USING (donor_key) GROUP BY ALL""",
    "top_sources": f"SELECT dst, src, CAST(a AS DOUBLE) AS amount, CAST(rank AS INTEGER) AS rank, CMTE_NM, terminal_type FROM {_top('dst', 'src', 'transferred')} JOIN typed ON src = CMTE_ID WHERE rank <= 10",
    "top_recipients": f"SELECT src, dst, CAST(a AS DOUBLE) AS amount, CAST(rank AS INTEGER) AS rank, CMTE_NM, terminal_type FROM {_top('src', 'dst', 'transferred')} JOIN typed ON dst = CMTE_ID WHERE rank <= 10",
    "more_sources": f"SELECT dst, count(*) FILTER (rank > 10) AS more, CAST(coalesce(sum(a) FILTER (rank > 10), 0) AS DOUBLE) AS more_amount FROM {_top('dst', 'src', 'transferred')} GROUP BY dst",
    "whale_counts": "SELECT cmte_id, whale_tier, count(*) AS n_edges, count(DISTINCT donor_key) AS n_donors FROM contributed JOIN donors USING (donor_key) WHERE whale_tier IS NOT NULL GROUP BY ALL",
    "donor_lean": "SELECT donor_key, CAST(dem AS DOUBLE) AS dem, CAST(rep AS DOUBLE) AS rep, CAST(other AS DOUBLE) AS other, " + _LEAN_PCT + ", lean FROM lean",
    "donor_top_candidates": f"""
        SELECT donor_key, t.cand_id, CAST(a AS DOUBLE) AS amount, CAST(rank AS INTEGER) AS rank, CAND_NAME
        FROM {_top('donor_key', 'cand_id', '(SELECT * FROM contributed JOIN links USING (cmte_id))')} t JOIN cn ON t.cand_id = cn.CAND_ID WHERE rank <= 10""",
    "committee_summary": """
        SELECT CMTE_ID, terminal_type, total_receipts, total_disbursed, i AS individual_total, m AS committee_total, n_donors, n_sources,
          CASE WHEN i + m > 0 THEN round(i / (i + m) * 100, 1) ELSE 0.0 END AS individual_pct, CASE WHEN i + m > 0 THEN round(m / (i + m) * 100, 1) ELSE 0.0 END AS committee_pct
        FROM (
          SELECT c.CMTE_ID, terminal_type, CAST(total_receipts AS DOUBLE) AS total_receipts, CAST(total_disbursed AS DOUBLE) AS total_disbursed,
            CAST(coalesce(g.i, 0) AS DOUBLE) AS i, CAST(coalesce(t.m, 0) AS DOUBLE) AS m, coalesce(g.n, 0) AS n_donors, coalesce(t.n, 0) AS n_sources
          FROM committees c LEFT JOIN (SELECT cmte_id, sum(total_amount) AS i, count(DISTINCT donor_key) AS n FROM contributed GROUP BY cmte_id) g ON g.cmte_id = c.CMTE_ID
          LEFT JOIN (SELECT dst, sum(total_amount) AS m, count(DISTINCT src) AS n FROM transferred GROUP BY dst) t ON t.dst = c.CMTE_ID
          WHERE total_receipts >= 100000)""",
    "donor_summary": f"""
        SELECT d.donor_key, donor_type, whale_tier, CAST(total_amount AS DOUBLE) AS total_amount, coalesce(k, 0) AS committees, least(coalesce(k, 0), 10) AS committee_count,
          coalesce(y, 0) AS active_cycles, coalesce(dem_pct, 0.0) AS dem_pct, coalesce(rep_pct, 0.0) AS rep_pct, coalesce(other_pct, 0.0) AS other_pct, coalesce(lean, 'UNKNOWN') AS lean
        FROM donors d LEFT JOIN (SELECT donor_key, count(DISTINCT cmte_id) AS k, count(DISTINCT cycle) AS y FROM contributed GROUP BY donor_key) USING (donor_key)
        LEFT JOIN (SELECT donor_key, {_LEAN_PCT}, lean FROM lean) USING (donor_key) WHERE total_amount >= 50000 AND donor_type IS DISTINCT FROM 'conduit'""",
    "direct_committees": "SELECT start AS cand_id, cmte_id FROM starts",
    "upstream_unweighted": "SELECT start, entity, terminal_type, name, CAST(total_amount AS DOUBLE) AS total_amount, paths FROM unweighted",
    "upstream_summary": f"SELECT start, {_CATEGORY} AS category, CAST(sum(total_amount) AS DOUBLE) AS total, count(*) AS sources FROM unweighted GROUP BY ALL",
    "upstream_top": f"""
        SELECT start, category, CAST(rank AS INTEGER) AS rank, entity, name, CAST(total_amount AS DOUBLE) AS amount FROM (
          SELECT *, row_number() OVER (PARTITION BY start, category ORDER BY total_amount DESC, entity, terminal_type) AS rank FROM (SELECT *, {_CATEGORY} AS category FROM unweighted))
        WHERE rank <= 10""",
    "upstream_first_visit": f"SELECT start, kind, entity, {_cents('amount')} AS amount FROM attributed_v",
    "upstream_depth3": f"SELECT start, kind, entity, {_cents('amount')} AS amount FROM attributed_d",
    "upstream_proportional": f"SELECT start, kind, entity, {_cents('amount')} AS amount FROM attributed",
    "funding_pies": f"""
        SELECT start, kind, {_cents('total')} AS total, round(CAST(total AS DOUBLE) / CAST(sum(total) OVER (PARTITION BY start) AS DOUBLE) * 100, 1) AS pct, sources
        FROM (SELECT start, kind, sum(amount) AS total, count(*) AS sources FROM attributed GROUP BY start, kind)""",
    "pie_top": f"""
        SELECT start, kind, CAST(rank AS INTEGER) AS rank, entity, {_cents('amount')} AS amount
        FROM (SELECT *, row_number() OVER (PARTITION BY start, kind ORDER BY amount DESC, entity) AS rank FROM attributed) WHERE rank <= 10""",
    "ie_support": _ie("S"),
    "ie_oppose": _ie("O"),
    "ie_spenders": "SELECT cand_id, support_oppose, cmte_id, CMTE_NM, CAST(sum(total_amount) AS DOUBLE) AS amount FROM spent JOIN cm USING (CMTE_ID) GROUP BY ALL",
    "corporate_influence": _CORPORATE,
    "source_ratio": "SELECT cmte_id, round(i, 6) AS i, round(o, 6) AS o, round(h, 6) AS h FROM r9",
    "candidate_summary": f"""
        SELECT start, {_cents("i + o")} AS total_raised, {_cents("i")} AS individual_total, {_cents("o")} AS organization_total,
          round(CAST(i AS DOUBLE) / CAST(i + o AS DOUBLE) * 100, 1) AS individual_pct, round(CAST(o AS DOUBLE) / CAST(i + o AS DOUBLE) * 100, 1) AS organization_pct,
          round(CAST(h AS DOUBLE) / CAST(r AS DOUBLE) + 1, 2) AS funding_distance
        FROM (
          SELECT start, sum({_PART.format("total_receipts", "i")}) AS i, sum({_PART.format("total_receipts", "o")}) AS o, sum({_PART.format("total_receipts", "h")}) AS h, sum(total_receipts) AS r
          FROM all_starts s JOIN committees c ON s.cmte_id = c.CMTE_ID JOIN r9 ON r9.cmte_id = s.cmte_id WHERE total_receipts > 0 GROUP BY start)
        WHERE i + o > 0""",
    "funding_totals": _TOTALS.format("all_starts"),
    "member_totals": _TOTALS.format("(SELECT * FROM all_starts UNION SELECT l.cand_id, l.cmte_id FROM linked l JOIN members m ON m.CAND_ID = l.cand_id WHERE m.known)"),
    "member_mapping": "SELECT bioguide, last, candidate_ids, committee_ids, chamber, state, party FROM mapping",
    "list_members": "SELECT bioguide, first, last, state, party, candidate_ids FROM mapping",
    "resolve_member": "SELECT first || ' ' || last AS name, candidate_ids, committee_ids FROM mapping WHERE contains(upper(first || ' ' || last), 'FIRST1 LAST1') OR contains('FIRST1 LAST1', upper(last)) ORDER BY bioguide LIMIT 1",
    "committee_merge": "SELECT cm.CMTE_ID, CMTE_NM || ' ' || max(cycle) AS CMTE_NM, CMTE_TP FROM cm JOIN affiliated a ON a.cmte_id = cm.CMTE_ID GROUP BY cm.CMTE_ID, CMTE_NM, CMTE_TP",
    "transaction_types": "SELECT cycle, CASE l_returnflag WHEN 'A' THEN '24A' WHEN 'R' THEN '24E' ELSE '24K' END AS TRANSACTION_TP, count(*) AS n FROM joined GROUP BY ALL",
    "filtered_transfers": """
        SELECT cycle, count(*) FILTER (entity IN ('PAC', 'COM', 'PTY', 'ORG')) AS kept, count(*) FILTER (entity NOT IN ('PAC', 'COM', 'PTY', 'ORG')) AS filtered_out
        FROM moves WHERE l_orderkey % 3 = 0 GROUP BY cycle""",
    "merged_committees": """
        WITH keyed AS (SELECT *, CAST(substr(CMTE_ID, 2) AS INTEGER) % 3 AS k FROM cm)
        SELECT mode, CMTE_ID, CASE WHEN k = 1 OR (mode = 'ignore' AND k = 2) THEN CMTE_NM ELSE upper(CMTE_NM) END AS CMTE_NM,
          CASE WHEN k = 1 OR (mode <> 'replace' AND k = 2) THEN CMTE_TP END AS CMTE_TP
        FROM keyed CROSS JOIN (SELECT unnest(['ignore', 'replace', 'update']) AS mode)""",
    "event_windows": """
        SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n, CAST(round(sum(CAST(value AS DECIMAL(18,6))), 2) AS DOUBLE) AS value
        FROM events GROUP BY ALL""",
    "resolve_candidate": "SELECT CAND_NAME AS name, CAND_ID AS candidate_ids, '' AS committee_ids FROM cn WHERE contains(upper(CAND_NAME), 'NATION') ORDER BY CAND_ID LIMIT 1",
    "donor_paths": """
        WITH best AS (SELECT donor_key FROM donors ORDER BY total_amount DESC, donor_key LIMIT 1), first AS (SELECT DISTINCT donor_key, cmte_id AS origin FROM contributed JOIN best USING (donor_key)),
        walk AS (
          SELECT donor_key, origin AS target, origin AS path, 0 AS hops FROM first
          UNION ALL SELECT donor_key, e.dst, origin || '>' || e.dst, 1 FROM first JOIN edges e ON e.src = origin
          UNION ALL SELECT donor_key, f.dst, origin || '>' || e.dst || '>' || f.dst, 2 FROM first JOIN edges e ON e.src = origin JOIN edges f ON f.src = e.dst AND f.dst <> origin)
        SELECT donor_key, cand_id, path, CAST(hops + 2 AS BIGINT) AS hops FROM walk JOIN (SELECT DISTINCT cmte_id, cand_id FROM affiliated) ON target = cmte_id""",
    "employer_influence": """
        SELECT e.name, cand_id, CAST(sum(c.total_amount) AS DOUBLE) AS amount, count(DISTINCT c.donor_key) AS donors
        FROM contributed c JOIN links USING (cmte_id) JOIN real r ON c.donor_key = r.donor_key JOIN employers e ON e.employer_key = r.employer_key GROUP BY e.name, cand_id""",
    "committee_inflow": " UNION ALL ".join(
        f"SELECT target, kind, CAST({k} AS BIGINT) AS hops, {_cents('sum(' + _PART.format('w', 'm') + ')')} AS amount FROM share{k} JOIN came USING (cmte_id) GROUP BY target, kind" for k in (1, 2, 3)
    ),
    "long_chains": " UNION ALL ".join(f"SELECT node AS origin, cand_id, CAST({k} AS BIGINT) AS hops, CAST(walks AS DOUBLE) AS walks FROM chain{k}" for k in (3, 4, 5)),
    "shortest_hops": "SELECT origin, target, min(hops) AS hops FROM hop_levels GROUP BY ALL",
    "graph_stats": " UNION ALL ".join(
        f"SELECT '{n}' AS collection, count(*) AS documents FROM {t}"
        for n, t in {
            "donors": "donors0", "employers": "employers", "committees": "cm", "candidates": "cn", "contributed_to": "contributed", "transferred_to": "transferred",
            "affiliated_with": "affiliated", "employed_by": "real", "spent_on": "spent",
        }.items()
    ),
    "skipped_edges": "SELECT cycle, count(*) AS n_edges, CAST(sum(t) AS DOUBLE) AS total_amount FROM contrib_groups WHERE donor_key NOT IN (SELECT donor_key FROM donors0) GROUP BY cycle",
}


#: The tables of one cycle; without receipts those of all cycles stay.
_OF_CYCLE = {n: f"SELECT * FROM ({PARTS[n]}) WHERE cycle = {_CYCLE}" for n in ("contributed", "transferred", "spent")}
#: Query -> (the body it shares, the parts that stand for others).
VARIANTS = {
    "upstream_cycle": ("upstream_proportional", _OF_CYCLE),
    "upstream_cycle_compat": (
        "upstream_proportional",
        _OF_CYCLE | {"committees": PARTS["committees"].replace("FROM contributed", f"FROM ({PARTS['contributed']})").replace("FROM transferred", f"FROM ({PARTS['transferred']})")},
    ),
    "ie_support_cycle": ("ie_support", _OF_CYCLE),
    "corporate_influence_cycle": ("corporate_influence", _OF_CYCLE),
    "restored_spending": ("ie_edges", {}),
    "raw_file_transfers": ("transfer_edges", {}),
    "raw_file_links": ("affiliation_edges", {}),
    "raw_file_spending": ("ie_edges", {}),
    "raw_files": ("contrib_edges", {"gifts": PARTS["gifts"].replace(", amt FROM indiv", ", CAST(amt AS DECIMAL(14,2)) AS amt FROM indiv")}),
}


def _needed(sql: str, parts: dict[str, str], found: list[str]) -> list[str]:
    """The parts that a text names, each after those it needs itself."""
    for word in re.findall(r"\b(?:FROM|JOIN)\s+\(?\s*(\w+)", sql):
        if word in parts and word not in found:
            _needed(parts[word], parts, found)
            found.append(word)
    return found


def oracle_sql() -> dict[str, str]:
    out = {}
    variants = {n: (BODIES[shared], own) for n, (shared, own) in VARIANTS.items()}
    for name, (body, own) in ({n: (b, {}) for n, b in BODIES.items()} | variants).items():
        parts = PARTS | own
        head = ",\n".join(f"{p} AS MATERIALIZED ({parts[p]})" for p in _needed(body, parts, []))
        out[name] = f"WITH {head}\nSELECT * FROM ({body})" if head else body
    return out
