import json

import shop
from stallbook.__main__ import main


def test_build_ask_embed_nearest(spark, raw_folder, tmp_path, capfd):
    root, vectors, expect = str(tmp_path / "shop"), str(tmp_path / "vectors"), tmp_path / "expect.json"
    expect.write_text(json.dumps({"landed_rows": shop.LANDED_ROWS, "typed_rows": shop.TYPED_ROWS, "imputed_orders": 1,
                                  "undelivered_orders": 3, "fallback_products": 1}))
    main(["build", "--csv", raw_folder, "--root", root, "--expect", str(expect)])
    main(["ask", "monthly_revenue", "--root", root])
    main(["embed", "--root", root, "--vectors", vectors, "--limit", "3"])
    main(["nearest", "o4", "--root", root, "--vectors", vectors])
    main(["profile", "--csv", raw_folder])
    out = capfd.readouterr().out
    assert "2018-05-01" in out and "109.98" in out and "\n3\n" in out
    assert out.count("very good product and seller") >= 1 and "reviews_per_order" in out


def test_all_rows_are_written(spark, tmp_path, capfd):
    from stallbook.__main__ import _report

    _report("numbers", spark.range(250).toDF("n"), str(tmp_path))
    assert "100 of 250 rows" in capfd.readouterr().out
    assert {row.n for row in spark.read.parquet(str(tmp_path / "numbers")).collect()} == set(range(250))
