from panelproj.functions import drop_suffix, parse_pack


def test_pack_text(spark):
    texts = ["TAB FILM 10MG  30", "SYRUP", "GEL TUBE", "5ML 10", "CAP 20MG X", "TAB  2 X 5 MG 7", None]
    df = parse_pack(spark.createDataFrame([(t,) for t in texts], "pack string"))
    got = {r.pack: (r.pack_form, r.pack_strength, r.pack_size) for r in df.collect()}
    assert got == {
        "TAB FILM 10MG  30": ("TAB FILM", "10MG", 30),
        "SYRUP": (None, None, None),
        "GEL TUBE": (None, None, None),
        "5ML 10": (None, "5ML", 10),
        "CAP 20MG X": ("CAP", "20MG", None),
        "TAB  2 X 5 MG 7": ("TAB", "2 X 5 MG", 7),
        None: (None, None, None),
    }


def test_drop_suffix(spark):
    df = spark.createDataFrame([("PU JI              S4I",), ("AB",), (None,)], "x string")
    assert [r[0] for r in df.select(drop_suffix("x", 3)).collect()] == ["PU JI", "", None]
