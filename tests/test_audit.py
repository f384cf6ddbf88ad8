import statistics

import pytest
from pyspark.sql import functions as F

from lexforge.operators import audit, fidelity

SUBJECTS = ["Cơ quan quản lý", "Tổ chức thực hiện", "Người đứng đầu", "Bộ trưởng", "Ủy ban nhân dân", "Doanh nghiệp", "Cá nhân", "Hội đồng"]
VERBS = ["có trách nhiệm thực hiện", "phải tuân thủ", "được quyền đề nghị", "chủ trì phối hợp", "kiểm tra việc", "báo cáo kết quả", "lập kế hoạch", "công bố"]
CLAUSES = ["các quy định tại Nghị định này", "nhiệm vụ được giao theo pháp luật", "hồ sơ trong thời hạn quy định", "phương án đối với từng khu vực", "nội dung của chương trình", "yêu cầu về an toàn", "kết quả của cuộc thanh tra"]


def clean(i):
    s = " ".join(f"{SUBJECTS[(i + k) % 8]} {VERBS[(i * 3 + k * 5) % 8]} {CLAUSES[(i * 2 + k * 3 + i // 8) % 7]}." for k in range(3))
    return f"{s} Văn bản số {chr(97 + i % 26)}{chr(97 + i // 26)} được ban hành và áp dụng trong cả nước."


def base(i, **change):
    row = {"chunk_id": f"doc1_{i}", "doc_id": "doc1", "link": "http://x", "name": "Nghị định", "structure": "dieu", "dieu": f"Điều {i}. Quy định", "part": "1", "title_confident": True, "content": clean(i)}
    row |= change
    row.setdefault("char_len", len(row["content"]))
    return row


SCHEMA = "seq long, chunk_id string, doc_id string, link string, name string, structure string, dieu string, part string, title_confident boolean, content string, char_len long"


def frame(spark, rows):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple({"seq": i, **r}[n] for n in names) for i, r in enumerate(rows)], SCHEMA)


PLANTED = {
    "dup_chunk_id": {"chunk_id": "doc1_3"},
    "empty_content": {"content": "   ", "char_len": 3},
    "char_len_mismatch": {"char_len": 999_999},
    "over_budget": {"content": clean(44) * 12},
    "no_dieu": {"dieu": ""},
    "title_guessed": {"title_confident": False},
    "no_link": {"link": "", "name": ""},
    "fragment_start": {"content": "a) " + clean(47).lower()},
    "orphan_part": {"part": "2", "dieu": "Điều 77. Một tiêu đề không có trong nội dung"},
    "toc": {"content": " ".join(f"Điều {i}. Tên điều." for i in range(1, 8)) + clean(49)},
    "boilerplate": {"content": "Nơi nhận: Như trên; Lưu: VT. " + clean(50)},
    "too_short": {"content": "Câu này chỉ có ba mươi ký tự."},
    "exact_dup": {"content": clean(5)},
    "near_dup": {"content": clean(6).replace(" ", "  ").replace(".", " .")},
    "template_dup": {"content": clean(60).replace("số", "số 12")},
    "junk_ratio": {"content": "Bảng " + "12.5; 13,7 / 14-15 (16) " * 8},
    "all_caps": {"content": "CÁC QUY ĐỊNH CỦA CƠ QUAN VÀ TỔ CHỨC TRONG NƯỚC " * 3},
    "not_vietnamese": {"content": "This paragraph is written in plain English and says nothing about the law. " * 4},
    "self_repeating": {"content": "Tổ chức và cá nhân được quy định tại điều này của luật. " * 14},
}


@pytest.fixture(scope="module")
def flagged(spark):
    rows = [base(i) for i in range(1, 41)] + [base(60, content=clean(60).replace("số", "số 7"))] + [base(100 + k, **({"content": clean(70 + k)} | v)) for k, v in enumerate(PLANTED.values())]
    return audit.flag_chunks(frame(spark, rows)).cache()


def test_clean_rows_have_no_findings(spark):
    found = audit.findings(audit.flag_chunks(frame(spark, [base(i) for i in range(1, 41)])))
    assert found.where("count > 0 and severity <> 'INFO'").collect() == []


def test_every_check_is_found(flagged):
    counts = {r["check"]: r["count"] for r in audit.findings(flagged).collect()}
    assert [k for k in PLANTED if not counts[k]] == [] and counts["bad_json"] == 0


def test_planted_rows_are_the_ones_hit(flagged):
    rows = {r.seq: r.hits for r in audit.hits(flagged).select("seq", "hits").collect()}
    for k, name in enumerate(PLANTED):
        assert name in rows[41 + k], name
    assert all(not rows[i] for i in range(40))


def test_cleaning_and_samples(spark, flagged):
    for profile in ("rag", "train"):
        kept = audit.clean_rows(flagged, profile)
        assert kept.where("seq < 40").count() == 40
        again = audit.findings(audit.flag_chunks(kept.select(*[c.split()[0] for c in SCHEMA.split(", ")])))
        bad = [r["check"] for r in again.where("count > 0").collect() if r["check"] in {*audit.PROFILES[profile], *audit.FATAL}]
        assert bad == []
    assert audit.samples(flagged, 1).groupBy("check").count().where("count > 1").count() == 0


def test_report(flagged):
    r = audit.report(flagged).first()
    assert r.rows_read == 60 and r.chunks_scored == 59 and r.failed and r.length.max >= r.length.p95 >= r.length.median >= r.length.min


def test_empty_table(spark):
    none = audit.flag_chunks(frame(spark, []))
    assert audit.length_stats(none).first().max == 0
    assert audit.findings(none).where("count > 0").count() == 0
    assert not audit.report(none).first().failed


def test_fidelity(spark):
    docs = spark.createDataFrame([("a", "Một hai ba. Bốn năm."), ("b", "Sáu bảy tám chín mười"), ("c", "không có")], "doc_id string, text string")
    chunks = spark.createDataFrame([("a", "Đ1", "Đ1 Một hai ba."), ("a", "", "Bốn  năm"), ("b", "", "Sáu"), ("z", "", "lạ")], "doc_id string, dieu string, content string")
    r = fidelity.fidelity_report(docs, chunks).first()
    assert (r.source_documents, r.documents_with_chunks, r.documents_with_no_chunks, r.documents_under_50pct_retained) == (3, 3, 1, 1)
    assert (r.containment_checked, r.containment_ok, r.containment_failed) == (3, 3, 0)
    assert [x.doc_id for x in fidelity.missing_documents(docs, chunks).collect()] == ["c"]
    assert [x.doc_id for x in fidelity.thin_documents(docs, chunks).collect()] == ["b"]


def test_median_without_a_task_that_sees_all(spark):
    for values in ([0.5], [0.1, 0.9], [0.25, 0.2501, 0.9], [1.0] * 50 + [0.3], [0.0, 0.0, 2.0, 3.0], [0.1 * i for i in range(41)]):
        rows = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
        assert fidelity.exact_median(rows, "x").first().median == statistics.median(values)
    assert fidelity.exact_median(spark.createDataFrame([], "x double"), "x").first().median is None


def test_report_in_one_pass(spark):
    rows = [(i, f"c{i % 9}", "Cơ quan thực hiện quy định của pháp luật " * 5 + "!" * (i % 3)) for i in range(20)]
    flagged = audit.flag_chunks(spark.createDataFrame(rows, "seq long, chunk_id string, content string"))
    r = audit.report(flagged, bad_json=2).first()
    assert r.rows_read == r.chunks_scored == 20 and r.findings["dup_chunk_id"]["count"] == 11 and r.findings["exact_dup"]["count"] == 17
    assert r.findings["near_dup"]["count"] == 2 and r.findings["bad_json"]["count"] == 2 and r.failed
