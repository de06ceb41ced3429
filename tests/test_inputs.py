import pytest

from tabaudit import session
from workload import inputs


def test_page_sentences_keep_all_text_between_tags(spark, tmp_path):
    html = "<html><head><title>Padi. Sawah</title><style>p {}</style></head><nav>Menu</nav><script>run()</script><p>Isi satu. Isi dua</p></html>"
    spark.createDataFrame([(1, "http://a.id/", html)], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    rows = inputs.page_sentences(spark, str(tmp_path)).orderBy("row_no").collect()
    assert [r.teks for r in rows] == ["Padi", "Sawah", "p {}", "Menu", "run()", "Isi satu", "Isi dua"]


def test_scratch_deletes_what_was_written_inside(spark, tmp_path):
    with session.scratch(spark):
        outer = session.written(spark.range(3))
        with session.scratch(spark):
            inner = session.written(outer.where("id > 0"))
            inner.write.parquet(str(tmp_path / "kept"))
        assert outer.count() == 3
        with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|not exist"):
            spark.read.parquet(*inner.inputFiles()).count()
    assert spark.read.parquet(str(tmp_path / "kept")).count() == 2
