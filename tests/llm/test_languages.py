import random

import zstandard

from ledgerloom.llm import langid


def test_samples_are_whole_texts_chosen_by_hash(spark):
    """Texts late in the alphabet and the ends of long texts are learned from as others are; repeated ids stay bounded."""
    r = random.Random(2)
    word = lambda: "".join(r.choice("bcdfgklmnprst") + r.choice("aeiou") for _ in range(3))
    rows = [(k, ("zzz " if k % 2 else "aaa ") + " ".join(word() for _ in range(20)) + f" tail{'xyz'[k % 3]}", "en") for k in range(600)]
    rows += [(k, " ".join(["ha"] * 5_000) + " finis", "la") for k in range(700, 710)] + [(800, f"hot row {k}", "en") for k in range(3_000)]
    learned = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    texts = learned["en"].split(b"\n")
    assert len(texts) <= langid.SAMPLE_DOCS
    plain = [t for t in texts if not t.startswith(b"hot")]
    assert min(sum(t.startswith(p) for t in plain) for p in (b"aaa", b"zzz")) > 0.3 * len(plain)
    assert all(t.endswith(b"finis") for t in learned["la"].split(b"\n"))


def test_names_equal_plain_compression():
    """Against a compressor made for each text, as the library documents it."""
    r = random.Random(3)
    raw = {lang: " ".join("".join(r.choice(a) for _ in range(5)) for _ in range(3_000)).encode() for lang, a in (("a", "abcde"), ("b", "bcdef"), ("c", "vwxyz"))}
    sizer = langid.Sizer(raw)
    for k in range(60):
        text = " ".join("".join(r.choice("abcdefvwxyz") for _ in range(5)) for _ in range(r.randint(1, 60)))
        sizes = {}
        for lang, own in raw.items():
            params = zstandard.ZstdCompressionParameters.from_level(langid.LEVEL, dict_size=len(own), window_log=len(own).bit_length() + 1)
            d = zstandard.ZstdCompressionDict(own, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=params)
            sizes[lang] = len(zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False).compress(langid.letters(text).encode()))
        best = min(sizes.items(), key=lambda x: (x[1], x[0]))
        assert sizer.name(text)[0] == best[0]


def test_ties_repeats_and_clashing_columns(spark):
    rows = [(1, "same text here", "aa"), (1, "same text here", "aa"), (2, "same text here", "bb"), (3, None, None), (None, "", "aa")]
    df = spark.createDataFrame([(*x, "x", 0.5) for x in rows], "doc_id long, text string, lang string, lang_pred string, score double")
    got = langid.report(df).collect()
    assert len(got) == 5 and sum(x.id == 1 for x in got) == 2
    sizer = langid.Sizer({"bb": b"one two", "aa": b"one two"})
    assert sizer.name("one two") == ("aa", 0.0)
    assert sizer.name("x" * 3_000_000)[0] == "aa"
