import corpus_pipeline as cp


def test_one_row_of_repeated_and_null_ids_stays(spark):
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(30))
    rows = [(1, text(1)), (1, text(1) + " more"), (1, text(1)), (2, text(2)), (None, text(2)), (None, text(3)), (None, text(3)), (None, None), (3, text(4)), (4, text(4))]
    df = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = cp.near_copies_out(spark, df, "")
    assert got.columns == list(cp.COLUMNS)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([(1, text(1)), (2, text(2)), (None, text(3)), (None, None), (3, text(4))], key=str)


def test_a_row_goes_only_with_a_copy_of_its_own(spark):
    """Of rows that share an id those without a copy stay, and of equal rows with one id one stays."""
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(30))
    rows = [(1, text(1)), (2, text(1)), (2, text(2)), (3, text(3)), (3, text(3))]
    df = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted((r.doc_id, r.text) for r in cp.near_copies_out(spark, df, "").collect()) == [(1, text(1)), (2, text(2)), (3, text(3))]


def test_stages_over_odd_rows(spark):
    """Null and repeated ids, null and empty and long texts, clashing columns, an empty table: each stage keeps what it has no reason to drop."""
    long = " ".join(f"w{i}" for i in range(20_000))
    rows = [(1, None), (None, "some words here"), (2, ""), (2, ""), (3, long), (None, None)]
    df = spark.createDataFrame([(k, t, "en", "s", 0, "x", 1, 2.0) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long, id string, row int, score double")
    sf = "/root/testdata/sf0.001"
    for name, stage in cp.STAGES:
        got = stage(spark, df, sf)
        want = 6
        assert got.count() == want, name
        assert stage(spark, df.limit(0), sf).count() == 0
