from types import SimpleNamespace

from tidemark.sources import versions


def test_views_read_a_version_that_was_written_with_other_types(spark, tmp_path, monkeypatch):
    """Views read all versions by the schema of one file, whichever comes first."""
    for k, names in enumerate((("a", "b"), ("b", "a"))):
        root, prefix, ids = f"{tmp_path}/{k}", f"types_{k}_", iter(names)
        monkeypatch.setattr(versions, "uuid", SimpleNamespace(uuid4=lambda: SimpleNamespace(hex=next(ids))))
        frame = spark.sql("SELECT CAST(1.25 AS DECIMAL(24,2)) AS v, 1 AS n").coalesce(1)
        versions.publish_version({"t": frame}, root)
        versions.create_views(spark, root, ["t"], prefix)
        versions.publish_version({"t": frame.selectExpr("v * 2 AS v", "n", "'new' AS more"), "u": frame}, root)
        assert [(float(r["v"]), r["n"]) for r in spark.table(f"{prefix}t").collect()] == [(2.5, 1)]
        assert versions.read_version(spark, root, ["t"])["t"].schema["v"].dataType.simpleString() == "decimal(24,2)"
        spark.sql(f"DROP VIEW {prefix}t")
