"""Micro fixtures B1-B4 with their full expected output (FIXTURES.md §B)."""

from conftest import d, frame, full_frame, rows_of, ts

from martloom.plans import company, direct_mail, email, taxonomy
from martloom.sources.control import LoadWindow

W = LoadWindow("test", ts("2024-01-10 00:00:00"), ts("2024-01-11 06:00:00"))
OLD = ts("2024-01-01 00:00:00")
RUN = W.run_ts


def h(hour: int):
    return ts(f"2024-01-10 {hour:02d}:00:00")


# ------------------------------------------------------------------ B1
CMPY_SRC = {
    "spls_cmpy_id": "string", "parnt_cmpy_id": "string", "ultmt_parnt_cmpy_id": "string", "cmpy_nm": "string",
    "website_url_txt": "string", "sic_cd": "string", "naics_cd": "string", "naics_dscr": "string",
    "emp_tot_cnt": "bigint", "hrc_lvl_nmb": "bigint", "hrc_src_typ_cd": "string", "hrc_to_revw_ind": "string",
    "mltpl_parnt_ind": "string", "row_stat_cd": "string", "row_updt_tms": "ts",
}
CMPY_TGT = {
    "spls_cmpy_ky": "bigint", "spls_cmpy_id": "string", "parnt_cmpy_ky": "bigint", "ultmt_parnt_cmpy_ky": "bigint",
    "cmpy_nm": "string", "website_url_txt": "string", "sic_cd": "string", "naics_cd": "string",
    "naics_dscr": "string", "emp_tot_cnt": "bigint", "hrc_lvl_nmb": "bigint", "hrc_src_typ_cd": "string",
    "hrc_to_revw_ind": "string", "mltpl_parnt_ind": "string", "row_insrt_tms": "ts", "row_updt_tms": "ts",
    "row_stat_cd": "string",
}


def company_inputs(spark):
    src = full_frame(spark, CMPY_SRC, [
        dict(spls_cmpy_id=i, parnt_cmpy_id=p, ultmt_parnt_cmpy_id=u, cmpy_nm=n, row_updt_tms=t, row_stat_cd=s)
        for i, p, u, n, t, s in [
            ("A", None, None, "A new", h(8), "UPDT"), ("B", "A", "A", "B", OLD, "NEW"),
            ("C", "E", "A", "C", OLD, "NEW"), ("D", None, None, "D", h(9), "DEL"),
            ("E", "A", "A", "E", h(10), "NEW"), ("F", "D", "D", "F", OLD, "NEW"),
            ("G", "Z", None, "G", h(11), "NEW"), ("H", "E", "A", "H", h(12), "DEL"),
        ]
    ])
    tgt = full_frame(spark, CMPY_TGT, [
        dict(spls_cmpy_ky=k, spls_cmpy_id=i, parnt_cmpy_ky=p, ultmt_parnt_cmpy_ky=u, cmpy_nm=n,
             row_insrt_tms=OLD, row_updt_tms=OLD, row_stat_cd=s)
        for k, i, p, u, n, s in [
            (1, "A", 0, 0, "A old", "NEW"), (2, "B", 1, 1, "B", "NEW"), (3, "C", -1, 1, "C", "NEW"),
            (4, "D", 0, 0, "D", "UPDT"), (5, "F", 4, 4, "F", "NEW"),
        ]
    ])
    return src, tgt


def test_b1_company(spark):
    src, tgt = company_inputs(spark)
    res = company.run(src, tgt, W, 100)
    assert res.high_water == 103 and res.assigned == 3
    got = rows_of(res.table, ["spls_cmpy_ky", "spls_cmpy_id", "parnt_cmpy_ky", "ultmt_parnt_cmpy_ky", "cmpy_nm",
                              "row_stat_cd", "row_updt_tms"])
    assert got == [
        (1, "A", 0, 0, "A new", "UPDT", RUN),
        (2, "B", 1, 1, "B", "NEW", OLD),
        (3, "C", 101, 1, "C", "NEW", RUN),
        (4, "D", 0, 0, "D", "DEL", RUN),
        (5, "F", -1, -1, "F", "NEW", RUN),
        (101, "E", 1, 1, "E", "NEW", RUN),
        (102, "G", -1, 0, "G", "NEW", RUN),
        (103, "H", 101, 1, "H", "DEL", RUN),
    ]
    ins = {r["spls_cmpy_id"]: r["row_insrt_tms"] for r in res.table.collect()}
    assert ins["E"] == RUN and ins["A"] == OLD


def test_b1_company_without_loopback_leaves_orphans(spark):
    src, tgt = company_inputs(spark)
    res = company.run(src, tgt, W, 100, loopback=False)
    got = dict((r[0], (r[1], r[2])) for r in rows_of(res.table, ["spls_cmpy_id", "parnt_cmpy_ky", "row_updt_tms"]))
    assert got["C"] == (-1, OLD) and got["F"] == (4, OLD)


# ------------------------------------------------------------------ B2
DRCT_SRC = {
    "spls_prsn_id": "string", "src_cd": "string", "promo_dt": "date", "spls_site_id": "string", "drop_dt": "date",
    "allctn_strt_dt": "date", "allctn_end_dt": "date", "last_ord_dt": "date", "promo_typ_cd": "string",
    "pdt_prmry_ctgry_nm": "string", "fsc_ytd_ordr_cnt": "bigint", "pr_12_prds_ordr_cnt": "bigint",
    "pr_3_prds_rvn_amt": "double", "pr_12_prds_rvn_amt": "double", "sls_rep_nm": "string",
    "row_stat_cd": "string", "row_updt_tms": "ts",
}
DRCT_TGT = {
    "drct_ml_promo_ky": "bigint", "src_cd": "string", "spls_prsn_id": "string", "spls_site_ky": "bigint",
    "promo_dt": "date", "drop_tm_ky": "bigint", "drop_dt": "date", "allctn_strt_tm_ky": "bigint",
    "allctn_strt_dt": "date", "allctn_end_tm_ky": "bigint", "allctn_end_dt": "date", "last_ord_tm_ky": "bigint",
    "last_ord_dt": "date", "promo_typ_cd": "string", "pdt_prmry_ctgry_nm": "string", "fsc_ytd_ord_cnt": "bigint",
    "pr_12_prds_ord_cnt": "bigint", "pr_3_prds_rvn_amt": "double", "pr_12_prds_rvn_amt": "double",
    "sls_rep_nm": "string", "row_updt_tms": "ts", "row_insrt_tms": "ts", "row_stat_cd": "string",
}


def calendar(spark):
    return frame(spark, {"cld_dt": "date", "tm_ky": "bigint"},
                 [(d("2024-01-01"), 1), (d("2024-01-02"), 2), (d("2024-01-03"), 3), (d("2024-01-04"), 4)])


def sites(spark):
    return frame(spark, {"spls_site_ky": "bigint", "spls_site_id": "string", "row_stat_cd": "string"},
                 [(10, "S1", "NEW"), (11, "S2", "UPDT"), (12, "S3", "DEL")])


def direct_source(spark):
    return full_frame(spark, DRCT_SRC, [
        dict(spls_prsn_id=p, src_cd=c, promo_dt=d(pd), spls_site_id=s, drop_dt=dd and d(dd),
             last_ord_dt=lo and d(lo), fsc_ytd_ordr_cnt=n, row_updt_tms=t, row_stat_cd=st)
        for p, c, pd, s, dd, lo, n, t, st in [
            ("P1", "X", "2024-01-01", "S1", "2024-01-02", "2024-01-04", 5, h(8), "NEW"),
            ("P2", "X", "2024-01-01", "S3", None, "2024-01-03", 1, h(9), "NEW"),
            ("P2", "Y", "2024-01-03", "S2", "2024-01-04", "2024-01-04", 2, h(10), "DEL"),
            ("P3", "Y", "2024-01-02", None, "2030-01-01", "2024-01-01", 3, h(11), "NEW"),
            ("P4", "X", "2024-01-01", "S2", "2024-01-02", "2024-01-02", 4, OLD, "NEW"),
            ("P5", "X", "2024-01-01", "S1", "2024-01-02", "2024-01-02", 6, OLD, "NEW"),
        ]
    ])


def test_b2_direct(spark):
    tgt = full_frame(spark, DRCT_TGT, [
        dict(drct_ml_promo_ky=k, spls_prsn_id=p, src_cd=c, promo_dt=d(pd), spls_site_ky=s, drop_tm_ky=dk,
             drop_dt=d(dd), last_ord_tm_ky=lk, fsc_ytd_ord_cnt=n, row_stat_cd=st, row_updt_tms=OLD,
             row_insrt_tms=OLD)
        for k, p, c, pd, s, dk, dd, lk, n, st in [
            (7, "P1", "X", "2024-01-01", 11, 1, "2024-01-01", 1, 1, "NEW"),
            (8, "P4", "X", "2024-01-01", -1, 2, "2024-01-02", 2, 4, "NEW"),
            (9, "P5", "X", "2024-01-01", 10, 2, "2024-01-02", 2, 6, "NEW"),
        ]
    ])
    res = direct_mail.run(direct_source(spark), tgt, sites(spark), calendar(spark), W, 500)
    assert res.high_water == 503
    cols = ["drct_ml_promo_ky", "spls_prsn_id", "src_cd", "promo_dt", "spls_site_ky", "drop_tm_ky", "drop_dt",
            "last_ord_tm_ky", "fsc_ytd_ord_cnt", "row_stat_cd", "row_updt_tms"]
    assert rows_of(res.table, cols) == [
        (7, "P1", "X", d("2024-01-01"), 11, 1, d("2024-01-01"), 4, 5, "UPDT", RUN),
        (8, "P4", "X", d("2024-01-01"), 11, 2, d("2024-01-02"), 2, 4, "NEW", RUN),
        (9, "P5", "X", d("2024-01-01"), 10, 2, d("2024-01-02"), 2, 6, "NEW", OLD),
        (501, "P2", "X", d("2024-01-01"), -1, None, None, 3, 1, "NEW", RUN),
        (502, "P2", "Y", d("2024-01-03"), 11, 4, d("2024-01-04"), 4, 2, "DEL", RUN),
        (503, "P3", "Y", d("2024-01-02"), 0, None, d("2030-01-01"), 1, 3, "NEW", RUN),
    ]


# ------------------------------------------------------------------ B3
EML_SRC = {
    "eml_ky": "bigint", "src_cd": "string", "eml_id": "string", "sent_dt": "date", "allctn_strt_dt": "date",
    "allctn_end_dt": "date", "last_ord_dt": "date", "fsc_ytd_ordr_cnt": "bigint", "pr_12_prds_ordr_cnt": "bigint",
    "pr_3_prds_rvn_amt": "double", "pr_12_prds_rvn_amt": "double", "sls_rep_nm": "string",
    "row_stat_cd": "string", "row_updt_tms": "ts",
}
EML_TGT = {
    "eml_promo_ky": "bigint", "eml_ky": "bigint", "src_cd": "string", "sent_dt": "date", "sent_tm_ky": "bigint",
    "allctn_strt_tm_ky": "bigint", "allctn_strt_dt": "date", "allctn_end_tm_ky": "bigint",
    "allctn_end_dt": "date", "sls_rep_nm": "string", "last_ord_tm_ky": "bigint", "last_ord_dt": "date",
    "fsc_ytd_ord_cnt": "bigint", "pr_12_prds_ord_cnt": "bigint", "pr_3_prds_rvn_amt": "double",
    "pr_12_prds_rvn_amt": "double", "row_insrt_tms": "ts", "row_updt_tms": "ts", "row_stat_cd": "string",
}


def email_source(spark):
    return full_frame(spark, EML_SRC, [
        dict(eml_ky=k, src_cd=c, sent_dt=d(s), last_ord_dt=lo and d(lo), fsc_ytd_ordr_cnt=n, row_updt_tms=t,
             row_stat_cd=st)
        for k, c, s, lo, n, t, st in [
            (1, "X", "2024-01-02", "2024-01-03", 5, h(8), "NEW"),
            (2, "X", "2024-01-02", None, 6, h(9), "NEW"),
            (1, "Y", "2030-01-01", "2024-01-01", 7, h(10), "DEL"),
            (3, "X", "2024-01-04", "2024-01-04", 8, OLD, "NEW"),
            (4, "X", "2024-01-04", "2024-01-04", 9, h(11), "DEL"),
        ]
    ])


def test_b3_email(spark):
    tgt = full_frame(spark, EML_TGT, [
        dict(eml_promo_ky=k, eml_ky=e, src_cd=c, sent_tm_ky=sk, sent_dt=d(s), last_ord_tm_ky=lk,
             fsc_ytd_ord_cnt=n, row_stat_cd=st, row_updt_tms=OLD, row_insrt_tms=OLD)
        for k, e, c, sk, s, lk, n, st in [
            (11, 1, "X", 1, "2024-01-01", 1, 1, "NEW"),
            (12, 3, "X", 1, "2024-01-01", 1, 1, "UPDT"),
            (13, 4, "X", 4, "2024-01-04", 4, 9, "NEW"),
        ]
    ])
    res = email.run(email_source(spark), tgt, calendar(spark), W, 700)
    assert res.high_water == 702
    cols = ["eml_promo_ky", "eml_ky", "src_cd", "sent_tm_ky", "sent_dt", "last_ord_tm_ky", "fsc_ytd_ord_cnt",
            "row_stat_cd", "row_updt_tms"]
    assert rows_of(res.table, cols) == [
        (11, 1, "X", 2, d("2024-01-02"), 3, 5, "UPDT", RUN),
        (12, 3, "X", 1, d("2024-01-01"), 1, 1, "UPDT", OLD),
        (13, 4, "X", 4, d("2024-01-04"), 4, 9, "DEL", RUN),
        (701, 1, "Y", None, d("2030-01-01"), 1, 7, "DEL", RUN),
        (702, 2, "X", 2, d("2024-01-02"), None, 6, "NEW", RUN),
    ]


# ------------------------------------------------------------------ B4
def test_b4_taxonomy(spark):
    str_cols = taxonomy.ATTRIBUTES + ["pdt_prmry_ctgry_nm"]
    src_schema = {"src_cd": "string", **{c: "string" for c in str_cols}, "cmpgn_strt_dt": "date",
                  "cmpgn_end_dt": "date", "drp_dt": "date", "row_stat_cd": "string", "row_updt_tms": "ts"}
    src = full_frame(spark, src_schema, [
        dict(src_cd=c, pgm_nm=n, row_updt_tms=t, row_stat_cd=s)
        for c, n, t, s in [("X", "x1", h(0), "NEW"), ("Y", "y1", h(0), "NEW"), ("V", "v1", h(0), "DEL"),
                           ("W", "w1", OLD, "NEW")]
    ])
    tgt_schema = {}
    for c in taxonomy.TARGET_COLUMNS:
        if c.endswith("_ky") or c.endswith("_cnt"):
            tgt_schema[c] = "bigint"
        elif c.endswith("_dt"):
            tgt_schema[c] = "date"
        elif c.endswith("_tms"):
            tgt_schema[c] = "ts"
        else:
            tgt_schema[c] = "string"
    tgt = full_frame(spark, tgt_schema, [
        dict(src_txnmy_ky=k, src_cd=c, pgm_nm=n, promo_site_cnt=9, promo_usr_cnt=9, promo_mstr_cust_cnt=9,
             promo_eml_cnt=9, row_stat_cd="NEW", row_updt_tms=OLD, row_insrt_tms=OLD)
        for k, c, n in [(3, "X", "x0"), (2, "W", "w1")]
    ])
    customers = frame(spark, {"cust_lvl": "string", "spls_site_ky": "bigint", "mstr_cust_ky": "string"},
                      [("SHIPTO", 10, "M1"), ("SHIPTO", 11, "M1"), ("SOLDTO", 12, "M2")])
    email_promos = frame(spark, {"src_cd": "string", "eml_id": "string"}, [("X", "e1"), ("X", "e2"), ("V", "e3")])
    emails = frame(spark, {"eml_id": "string", "eml_ky": "bigint"}, [("e1", 1), ("e2", 2)])
    bridge = frame(spark, {"eml_ky": "bigint", "oms_usr_ky": "string"}, [(1, "u1"), (1, "u2"), (2, "u1")])
    users = frame(spark, {"oms_usr_ky": "string", "mstr_cust_ky": "string"}, [("u1", "M1"), ("u2", "M2")])
    res = taxonomy.run(src, tgt, calendar(spark), W, 40, direct_promos=direct_source(spark), sites=sites(spark),
                       customers=customers, email_promos=email_promos, emails=emails, bridge=bridge, users=users)
    assert res.high_water == 42
    cols = ["src_txnmy_ky", "src_cd", "pgm_nm", "promo_site_cnt", "promo_usr_cnt", "promo_mstr_cust_cnt",
            "promo_eml_cnt", "row_stat_cd"]
    assert rows_of(res.table, cols) == [
        (2, "W", "w1", 9, 9, 9, 9, "NEW"),
        (3, "X", "x1", 3, 4, 1, 2, "UPDT"),
        (41, "V", "v1", None, None, 0, 1, "DEL"),
        (42, "Y", "y1", 1, 2, 1, None, "NEW"),
    ]


def test_case_blind_keys_option(spark):
    """With collated keys 'a ' in the source matches 'A' in the target (and
    its parent reference 'a' resolves), as in a case-blind SQL session."""
    from martloom.functions import collate_keys

    src = full_frame(spark, CMPY_SRC, [
        dict(spls_cmpy_id="a ", cmpy_nm="A2", row_updt_tms=h(8), row_stat_cd="NEW"),
        dict(spls_cmpy_id="b", parnt_cmpy_id="a", cmpy_nm="B", row_updt_tms=h(9), row_stat_cd="NEW"),
    ])
    tgt = full_frame(spark, CMPY_TGT, [dict(spls_cmpy_ky=1, spls_cmpy_id="A", parnt_cmpy_ky=0, ultmt_parnt_cmpy_ky=0,
                                            cmpy_nm="A1", row_insrt_tms=OLD, row_updt_tms=OLD, row_stat_cd="NEW")])
    cols = ["spls_cmpy_id", "parnt_cmpy_id", "ultmt_parnt_cmpy_id"]
    res = company.run(collate_keys(src, cols), collate_keys(tgt, cols), W, 1)
    got = rows_of(res.table, ["spls_cmpy_ky", "cmpy_nm", "parnt_cmpy_ky", "row_stat_cd"])
    assert got == [(1, "A2", 0, "UPDT"), (2, "B", 1, "NEW")]
    binary = company.run(src, tgt, W, 1)
    assert binary.table.count() == 3  # byte-wise: 'a ' is a new company


def test_duplicate_live_site_fails_before_any_write(spark):
    import pytest

    from martloom.operators.guards import GuardError

    dup_sites = sites(spark).unionByName(frame(spark, {"spls_site_ky": "bigint", "spls_site_id": "string",
                                                         "row_stat_cd": "string"}, [(99, "S1", "NEW")]))
    tgt = full_frame(spark, DRCT_TGT, [])
    with pytest.raises(GuardError):
        direct_mail.run(direct_source(spark), tgt, dup_sites, calendar(spark), W, 500, check_lookups=True)
    # a duplicate that is not live is no fan-out
    ok_sites = sites(spark).unionByName(frame(spark, {"spls_site_ky": "bigint", "spls_site_id": "string",
                                                        "row_stat_cd": "string"}, [(98, "S1", "DEL")]))
    res = direct_mail.run(direct_source(spark), tgt, ok_sites, calendar(spark), W, 500, check_lookups=True)
    assert res.table.count() == 4


def test_b3_email_with_frozen_delta_and_newest_wins_dedupe(spark):
    """freeze_delta gives the same load; a duplicated key with dedupe_by keeps the newest row (X16)."""
    import pytest

    from martloom.operators.guards import GuardError

    tgt = full_frame(spark, EML_TGT, [])
    src = email_source(spark)
    frozen = email.run(src, tgt, calendar(spark), W, 700, freeze_delta=True)
    plain = email.run(src, tgt, calendar(spark), W, 700)
    cols = ["eml_promo_ky", "eml_ky", "src_cd", "fsc_ytd_ord_cnt", "row_stat_cd"]
    assert rows_of(frozen.table, cols) == rows_of(plain.table, cols)

    dup = src.unionByName(full_frame(spark, EML_SRC, [
        dict(eml_ky=2, src_cd="X", sent_dt=d("2024-01-02"), fsc_ytd_ordr_cnt=60, row_updt_tms=h(23),
             row_stat_cd="UPDT")]))
    with pytest.raises(GuardError):
        email.run(dup, tgt, calendar(spark), W, 700)
    res = email.run(dup, tgt, calendar(spark), W, 700, dedupe_by=["row_updt_tms"])
    got = {r["eml_ky"]: r["fsc_ytd_ord_cnt"] for r in res.table.filter("src_cd = 'X'").collect()}
    assert got[2] == 60 and res.table.count() == 4
