"""The coverage ledger on planted gaps."""

import json

from tarnwork.plans import coverage

PAGES = "feed string, low string, high string, start_index int, results int, total int"


def test_marks_end_before_the_first_gap(spark):
    pages = [
        ("whole", "1", "2", 0, 10, 15), ("whole", "1", "2", 10, 5, 15), ("whole", "2", "3", 0, 0, 0),
        ("lost", "1", "2", 0, 10, 10), ("lost", "2", "3", 0, 10, 30), ("lost", "2", "3", 20, 10, 30), ("lost", "3", "4", 0, 1, 1),
        ("short", "1", "2", 0, 10, 11), ("hole", "1", "2", 0, 1, 1), ("hole", "3", "4", 0, 1, 1),
        ("twice", "1", "2", 0, 10, 12), ("twice", "1", "2", 0, 10, 12), ("twice", "1", "2", 8, 4, 12), ("late", "1", "2", 5, 5, 10), ("null", None, "9", None, 3, None),
    ]
    got = {r["feed"]: (r["windows"], r["done"], r["mark"]) for r in coverage.marks(coverage.windows_of(spark.createDataFrame(pages, PAGES), ["feed", "low", "high"]), "feed").collect()}
    assert got == {"whole": (2, 2, "3"), "lost": (3, 1, "2"), "short": (1, 0, None), "hole": (2, 1, "2"), "twice": (1, 1, "2"), "late": (1, 0, None), "null": (1, 0, None)}
    assert coverage.marks(coverage.windows_of(spark.createDataFrame([], PAGES), ["feed", "low", "high"]), "feed").count() == 0


def test_landed_windows_are_folders(spark, tmp_path):
    def page(window, start, n, total):
        (tmp_path / window).mkdir(exist_ok=True)
        (tmp_path / window / f"{start}.json").write_text(json.dumps({"startIndex": start, "totalResults": total, "vulnerabilities": [{"cve": {"id": f"CVE-{start + i}"}} for i in range(n)]}))

    page("a", 0, 2, 3)
    page("a", 2, 1, 3)
    page("b", 0, 1, 1)
    assert coverage.all_landed(spark, str(tmp_path))
    page("b", 2, 1, 3)
    assert not coverage.all_landed(spark, str(tmp_path))
