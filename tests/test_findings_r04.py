"""Cases of the findings of review 4."""


def test_fingerprints_meet_only_where_they_share_bits(spark, monkeypatch, tmp_path):
    """Comparisons stay far below the square of the fingerprints, and no near pair is lost."""
    import random

    import numpy as np

    from basetide.llm import simhash
    from basetide.llm.components import components

    rng = random.Random(5)
    prints = [rng.getrandbits(64) for _ in range(16_000)]
    near = []  # four bits, all over
    for p in prints[:200]:
        q = p
        for b in rng.sample(range(64), 4):
            q ^= 1 << b
        near.append((p, q))
    values = np.array(list({*prints, *(q for _, q in near)}), np.uint64).view(np.int64).tolist()
    whole, folder = simhash.tile_links, str(tmp_path)

    def counted(a, b, radius, same):
        import os

        with open(f"{folder}/{os.getpid()}", "a") as f:
            f.write(f"{len(a) * len(b)}\n")
        return whole(a, b, radius, same)

    monkeypatch.setattr(simhash, "tile_links", counted)
    links = simhash.near_links(spark.createDataFrame([(v,) for v in values], "fp long").repartition(4))
    root = {r.node % 2 ** 64: r.root for r in components(links).collect()}
    compared = sum(int(line) for p in tmp_path.iterdir() for line in p.read_text().split())
    assert len(root) >= 400 and all(root[p] == root[q] for p, q in near)
    assert 0 < compared < len(values) ** 2 / 100


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_concatenated_texts_move_once_to_their_tile(spark):
    """Groups inside a tile are put together where the tile's texts are; groups that tiles share come out the same."""
    from pyspark.sql import functions as F

    from basetide import adapters as A
    from basetide.operators import alignment, intervals

    d = "/root/testdata/sf0.001"
    features = intervals.make_windows(A.contigs(spark, d), 250).where(F.floor(F.col("start") / 250) % 3 != 1)
    narrow, wide = (alignment.concat_blocks(A.blocks(spark, d), features, 200, tile_width=w) for w in (512, 1 << 20))
    plan = _plan(narrow)
    assert narrow.count() > 100
    assert sorted(map(str, narrow.collect())) == sorted(map(str, wide.collect()))
    # the tile's texts and numbers, on both sides of the union, and what tiles share
    assert plan.count("Exchange hashpartitioning") <= 5 and "regexp_extract_all" not in plan


def test_blocks_move_to_a_region_as_one_row(spark, tmp_path):
    """Rows are taken apart behind the last shuffle of texts, which also brings regions in the order of their files."""
    from basetide import adapters as A
    from basetide.operators import alignment, intervals
    from basetide.sources import readers, sinks

    d = "/root/testdata/sf0.001"
    regions = intervals.make_windows(A.contigs(spark, d), 250)
    plain = alignment.fetch_regions(A.blocks(spark, d), regions, ref="doc")
    plan = _plan(plain)
    assert plan.index("posexplode(rows") < plan.index("Exchange ")
    ordered = alignment.fetch_regions(A.blocks(spark, d), regions, ref="doc", ordered=True)
    assert sorted(map(str, plain.collect())) == sorted(map(str, ordered.collect()))
    few = ordered.where("chrom = 'ctg0' OR chrom = 'ctg3'")
    few = few.withColumn("seq", alignment.F.translate("seq", " \n\t\r>", "_____"))
    sinks.write_fasta_batches(few, str(tmp_path / "moved"))
    sinks.write_fasta_batches(few, str(tmp_path / "placed"), placed=True, compression="gzip")
    found = [[(r.title, r.seq) for r in readers.read_fasta(spark, str(tmp_path / p), "part-*").orderBy("file").collect()]
             for p in ("moved", "placed")]
    names = [t.rsplit(" ", 1)[1] for t, _ in found[1]]
    assert found[0] and sorted(found[0]) == sorted(found[1]) and names == sorted(names)


def test_whole_codons_are_decided_in_their_block():
    """Only codons that count and those at the borders of a block leave its task."""
    import pandas as pd

    from basetide.operators.patterns import _codons_touched

    def rows(ref, ahead):
        one = pd.DataFrame([("c", 60, 60, [ref, ref, ref.lower()], *(pd.Series([x]).to_numpy() for x in (0, 600, ahead, 1, -1, -1, -1)))])
        return sum(len(x) for x in _codons_touched(iter([one])))

    assert rows("GGA" * 20, True) <= 2  # GAG 19 times
    assert rows("GGA" * 20, False) == 19 + 2  # CTC


def test_fourfold_columns_of_overlapping_blocks(spark):
    """A codon whole in one block gets its columns from all blocks that hold its third base."""
    import random

    from basetide.operators import patterns

    rng = random.Random(8)
    genome = "".join(rng.choice("ACGTacgt") for _ in range(400))
    spans = {(s, rng.randrange(1, 60)) for s in range(0, 330, 11) if rng.random() < 0.7} | {(350, 20), (370, 30)}
    spans |= {(350, 19)}
    blocks, rows = [], []
    for k, (s, n) in enumerate(sorted(spans)):
        texts = [genome[s:s + n], "".join(rng.choice("ACGT-") for _ in range(n))]
        blocks.append((s, n, texts))
        rows.append((k, "c", s, n, [(sp, "c", s, n, "+", 400, t) for sp, t in zip(("ref", "x"), texts)]))
    schema = ("block_id long, chrom string, start long, size long, rows array<struct<species:string,scaffold:string,start:long,size:long,"
              "strand:string,src_size:long,text:string>>")
    gff = [("c", "s", "CDS", 1, 200, ".", "+", "0", "ID=a"), ("c", "s", "CDS", 150, 400, ".", "-", "1", "ID=b")]
    features = spark.createDataFrame(gff, "seqid string, source string, type string, start long, end long, score string, strand string, phase string, "
                                          "attributes string")
    codons = [(p, p + 1, p + 2, True) for p in range(0, 198, 3)] + [(p, p - 1, p - 2, False) for p in range(398, 150, -3)]
    want = set()
    for b1, b2, b3, ahead in codons:
        if all(any(s <= b < s + n for s, n, _ in blocks) for b in (b1, b2, b3)):
            two = (genome[b1] + genome[b2]).upper()
            two = two if ahead else "".join(patterns.COMPLEMENT[c] for c in two)
            if two in patterns.FOURFOLD_PREFIXES:
                want |= {("c", b3, t[0][b3 - s] + t[1][b3 - s]) for s, n, t in blocks if s <= b3 < s + n}
    table = spark.createDataFrame(rows, schema)
    got = [tuple(r) for r in patterns.fourfold_columns(table, features, ["ref", "x"]).collect()]
    assert len(want) > 40 and len(got) == len(set(got)) and set(got) == want
    index = table.select("chrom", "start", "size")
    assert {tuple(r) for r in patterns.fourfold_columns(table, features, ["ref", "x"], index).collect()} == want


def test_declared_articles_go_through_the_suffix_arrays(spark):
    """Words of articles that stand on other pages of the host are counted, and the articles stay whole."""
    import random

    from basetide.llm import page_text

    rng = random.Random(6)
    words = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    shared, notice = words(15), words(9)
    rows, want = [], {}
    for k in range(40):
        own = words(rng.randrange(3, 200))
        cut = rng.randrange(0, 7)  # of 15 shared words
        part = " ".join(shared.split()[cut:])
        host = f"h{k % 2}.example.org"
        menu = f"<nav>{notice}</nav>" if k % 4 < 2 else ""
        rows.append((k, f"https://{host}/{k}", f"<article><p>{own} {part}</p></article>{menu}"))
        want[k] = (f"{own} {part}", 15 - cut + (9 if menu else 0))
    rows.append((90, "https://alone.example.org/", f"<article>{shared} {shared}</article>"))
    want[90] = (f"{shared} {shared}", 0)
    rows.append((91, "https://h0.example.org/", f"<main>{notice}</main>"))
    want[91] = (notice, 9)
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    level, _, _, streams = page_text.read_page(rows[0][2])
    assert level == 2 and sum(s[2][-1] for s in streams) == len(want[0][0].split()) + 9
    for anchors in (page_text.ANCHORS, 0):
        got = {r.page_id: (r.text, r.n_repeated) for r in page_text.main_text(df, anchors=anchors).collect()}
        assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
        assert got == want
