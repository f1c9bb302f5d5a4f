from basetide.operators import alignment, patterns, samples, sites, tree
from basetide.sources import readers as R
from basetide.sources import sinks as K
from basetide.sources.newick import newick_to_nodes


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def test_bed_and_bedgraph(spark, fixtures):
    assert len(rows(R.read_bed(spark, f"{fixtures}/mini.bed", "name string"))) == 6
    assert rows(R.read_bedgraph(spark, f"{fixtures}/mini.bedgraph")) == [("chr1", 0, 1, 0.5), ("chr1", 1, 2, -1.25)]


def test_wig_positions_shift_to_zero_based(spark, fixtures):
    got = rows(sites.classify_scores(R.read_wig_fixedstep(spark, f"{fixtures}/mini.wig")), "chrom", "start", "end", "score", "status")
    assert got == [("chr1", 10, 11, 1.5, 0), ("chr1", 11, 12, -2.0, 2), ("chr1", 12, 13, 0.0, 1),
                   ("chr2", 0, 1, 0.25, 0), ("chr2", 10, 11, 3.0, 0)]


def test_fai_order(spark, fixtures):
    df = R.read_fai(spark, f"{fixtures}/mini.fai", "chr")
    assert [r.chrom for r in df.orderBy("ord").collect()] == ["chr1", "chr2", "chrX"]


def test_maf_blocks(spark, fixtures):
    b = R.read_maf(spark, f"{fixtures}/mini.maf")
    assert rows(b, "chrom", "start", "size") == [("chr1", 0, 10), ("chr1", 10, 6), ("chr1", 16, 8), ("chr2", 3, 4)]
    third = b.where("start = 16").first()
    assert third.rows[2].species == "spB" and third.rows[2].scaffold == "sc2.v1" and third.rows[2].strand == "-"
    assert rows(alignment.block_summary(b), "ref_scaffold", "ref_start", "aln_len", "line_len", "n_seqs")[-1] == ("chr2", 3, 4, 5, 2)


def test_depth_counts_first_copy_and_skips_unknown(spark, fixtures):
    b = R.read_maf(spark, f"{fixtures}/mini.maf")
    d = rows(alignment.maf_depth(b))
    assert d[:5] == [("chr1", 0, 3, 3), ("chr1", 3, 5, 2), ("chr1", 5, 8, 3), ("chr1", 8, 9, 2), ("chr1", 9, 10, 3)]
    assert ("chr1", 10, 16, 3) in d and ("chr1", 16, 24, 3) in d
    assert [x for x in d if x[0] == "chr2"] == [("chr2", 3, 5, 2), ("chr2", 5, 6, 1), ("chr2", 6, 8, 2)]
    skip = rows(alignment.maf_depth(b.where("chrom = 'chr2'"), skip_ref_gaps=True))
    assert skip == [("chr2", 3, 7, 2)]


def test_fasta_dedup_complete_prune(spark, fixtures, tmp_path):
    fa = R.read_fasta(spark, f"{fixtures}/mini_fa")
    assert rows(fa, "title", "seq") == [("spA.sc1:0-4", "AC-T"), ("spA.sc1:4-8", "ACGT"), ("spA.sc2:9-12", "ACG-"), ("spB.sc1:0-4", "ACGT")]
    aln = R.fasta_alignments(fa)
    best = alignment.dedup_species(aln, order=("title",))
    assert rows(best, "region_id", "title") == [("ref-chr1-0-4", "spA.sc1:0-4"), ("ref-chr1-0-4", "spB.sc1:0-4"), ("ref-chr1-4-8", "spA.sc1:4-8")]
    assert rows(alignment.region_bed(alignment.complete_regions(best, 2))) == [("chr1", 0, 4)]
    assert alignment.complete_regions(best, 0).count() == 3
    prune = R.read_lines(spark, f"{fixtures}/prune.txt")
    assert rows(alignment.prune_species(best, prune), "species") == [("spA",), ("spA",)]


def test_ss_filter_round_trip(spark, fixtures, tmp_path):
    header, pats = R.read_ss(spark, f"{fixtures}/mini.ss")
    assert dict(rows(header))["NAMES"] == "a,b,c,d,e"
    # 5 x 0.5 = 2.5 rounds to 2; pattern 2 misses two species but counts twice, so 4 > 2
    kept = patterns.filter_patterns(pats, 5, 0.5)
    assert rows(kept) == [(0, "ACGTA", 4), (1, "A**TA", 1), (2, "*CGTA", 1)]
    assert rows(patterns.filter_patterns(pats, 5, 0.5, per_site=True), "pattern")[0] == ("*CGTA",)
    assert patterns.filter_patterns(pats, 5, 0.5, per_site=True).count() == 5
    stats = {(r["var"], r["filter_cat"]): r["value"] for r in patterns.pattern_summary(pats, 5, 0.5).collect()}
    assert stats["aln.len", "pre.filter"] == 12 and stats["aln.len", "post.filter"] == 6
    assert stats["total.missing.cols", "pre.filter"] == 2 + 4 + 1 + 3 + 3 and stats["num.seqs", "post.filter"] == 5
    K.write_ss(header, kept, str(tmp_path / "out"))
    again_h, again_p = R.read_ss(spark, str(tmp_path / "out"))
    assert dict(rows(again_h))["LENGTH"] == "6" and dict(rows(again_h))["NTUPLES"] == "3"
    assert rows(again_p) == rows(kept)


def test_lost_species_fails(spark):
    import pytest

    df = spark.createDataFrame([(0, "A*", 3), (1, "C*", 1)], "idx long, pattern string, n long")
    with pytest.raises(ValueError):
        patterns.filter_patterns(df, 2, 2.0)


def test_gff(spark, fixtures):
    g = R.read_gff(spark, f"{fixtures}/mini.gff")
    assert g.where("pragma is not null").count() == 2 and g.count() == 5
    assert rows(R.gff_for_chrom(g, "chr1", "ref.").where("type is not null"), "seqid", "type") == [("ref.chr1", "CDS"), ("ref.chr1", "chromosome")]
    assert R.gff_chromosomes(g).count() == 1
    cod = rows(patterns.codon_positions(g))
    assert ("chr1", "+", 0, 1, 2) in cod and len([c for c in cod if c[0] == "chr1"]) == 3
    assert [c for c in cod if c[0] == "chr2"] == [("chr2", "-", 5, 4, 3)]


def test_samples_and_gc(spark, fixtures, tmp_path):
    import pytest

    s = R.read_samples(spark, f"{fixtures}/samples.csv")
    assert s.columns == ["species", "accession", "gc"] and s.count() == 4
    lookup = spark.createDataFrame([("ACC2", "40.0"), ("ACC3", None)], "accession string, gc string")
    f = samples.fill_gc(s, lookup)
    assert rows(f, "accession", "gc_source") == [("ACC1", "sheet"), ("ACC2", "lookup"), ("ACC3", "no_value"), ("ACC4", "failed")]
    assert abs(samples.avg_gc(f).first()[0] - 0.4075) < 1e-12
    K.write_samples(f, str(tmp_path / "s"), str(tmp_path / "avg"))
    assert rows(spark.read.option("header", True).csv(str(tmp_path / "s")), "accession", "gc")[2:] == [("ACC3", "NA"), ("ACC4", "NA")]
    with pytest.raises(ValueError):
        R.read_samples(spark, f"{fixtures}/chr.sites.0.05.80.txt")


def test_counts_from_file_names(spark, fixtures):
    c = R.read_counts(spark, f"{fixtures}/chr.sites.*.txt", r"sites\.([\d.]+)\.(\d+)\.txt", ["alpha", "cutoff"])
    assert rows(c) == [("chr1", 7, "0.05", "100"), ("chr1", 10, "0.05", "80"), ("chr2", 1, "0.05", "100"), ("chr2", 5, "0.05", "80")]


def test_elem_lik(spark, fixtures):
    from basetide.operators.grid import classify_acceleration

    got = rows(classify_acceleration(R.read_elem_lik(spark, f"{fixtures}/elem_lik.txt")), "elem", "accelerated", "displayed")
    assert got == [("e1", "Accelerated", True), ("e2", "Not accelerated", False)]


def test_newick_clades_and_trait(spark, fixtures):
    text = open(f"{fixtures}/mini.nh").read().strip()
    nodes = newick_to_nodes(spark.createDataFrame([("t", text)], "tree_id string, newick string"))
    info = {r["label"]: (r["clade"], r["node_type"], r["branch_length"]) for r in tree.tree_info(nodes).collect()}
    assert info["root"] == ("t1;t2;t3;t4;t5", "ROOT", None)
    assert info["n3"] == ("t3;t4;t5", "internal", 0.8) and info["t4"] == ("t4", "tip", 0.5)
    meta = spark.createDataFrame([("t4", "yes"), ("t5", "x"), ("t1", "")], "species string, echo string")
    marked = tree.propagate_trait(tree.annotate_tree(nodes, meta, "echo"), "echo")
    assert {r["label"] for r in marked.where("echo = 'Y'").collect()} == {"t4", "t5", "n2"}


def test_topology_functions(spark, fixtures):
    from basetide.functions.sequences import strip_topology, tip_labels

    df = spark.read.text(f"{fixtures}/mini.nh")
    r = df.select(strip_topology("value"), tip_labels("value")).first()
    assert r[0] == "((t1,t2),(t3,(t4,t5)))" and r[1] == ["t1", "t2", "t3", "t4", "t5"]


def test_bed_fasta_and_maf_sinks(spark, fixtures, tmp_path):
    bed = R.read_bed(spark, f"{fixtures}/mini.bed", "name string")
    K.write_bed(bed, str(tmp_path / "bed"))
    assert rows(R.read_bed(spark, str(tmp_path / "bed"), "name string")) == rows(bed)
    b = R.read_maf(spark, f"{fixtures}/mini.maf")
    regions = spark.createDataFrame([("chr1", 0, 24)], "chrom string, start long, end long")
    aln = alignment.fetch_regions(b, regions)
    K.write_fasta(aln, str(tmp_path / "fa"))
    text = open(next((tmp_path / "fa" / "region=ref-chr1-0-24").glob("part*"))).read()
    assert text.startswith(">ref.chr1:0-24\nACGTACGTACGGGTTTCCCCAAAA\n>spA.sc1:5-")
    K.write_maf_partitioned(b, str(tmp_path / "maf"))
    again = R.read_maf(spark, f"{tmp_path}/maf/chrom=chr1")
    assert rows(again, "start", "size") == [(0, 10), (10, 6), (16, 8)]
    wins = spark.createDataFrame([("chr1", 0, 12, "00"), ("chr1", 12, 24, "01")], "chrom string, start long, end long, win string")
    K.write_maf_partitioned(b, str(tmp_path / "split"), wins, max_blocks=1)
    files = list((tmp_path / "split").glob("chrom=chr1/win=*/part*"))
    assert len(files) == 4 and all(f.read_text().count("a\n") == 1 for f in files)
    back = R.read_maf(spark, str(tmp_path / "split"), ("chrom", "win"))
    assert rows(back, "in_chrom", "in_win", "start") == [("chr1", "00", 0), ("chr1", "00", 10), ("chr1", "01", 10), ("chr1", "01", 16)]
    assert rows(K.split_blocks(b, wins), "win", "start") == [("00", 0), ("00", 10), ("01", 10), ("01", 16)]


def test_hmm_log_round_trip(spark, tmp_path):
    from basetide.operators import segment

    s = spark.createDataFrame([("c", 3, 4)], "chrom string, start long, end long")
    c = spark.createDataFrame([("c", 50)], "chrom string, length long")
    p = [segment.HmmParams(0, 0.9, 0.9, 0.9, 0.9, 1.0)]
    out = segment.hmm_summary(segment.hmm_segment(s, c, p), s, c, p)
    K.write_hmm_log(out, str(tmp_path / "log"))
    back = R.read_hmm_logs(spark, str(tmp_path / "log")).collect()
    assert len(back) == 1 and back[0]["conserved_sites"] == 1 and back[0]["t0_0"] == 0.9


def test_bed_fields_stand_as_they_are(spark, tmp_path):
    bed = spark.createDataFrame([("c", 0, 1, 'a "b"'), ("c", 1, 2, " x "), ("c", 2, 3, "it's")], "chrom string, start long, end long, name string")
    K.write_bed(bed, str(tmp_path / "bed"))
    assert rows(R.read_bed(spark, str(tmp_path / "bed"), "name string")) == rows(bed)


def test_fasta_batches_round_trip(spark, fixtures, tmp_path):
    b = R.read_maf(spark, f"{fixtures}/mini.maf")
    regions = spark.createDataFrame([("chr1", 0, 12), ("chr1", 12, 24)], "chrom string, start long, end long")
    aln = alignment.fetch_regions(b, regions)
    K.write_fasta_batches(aln, str(tmp_path / "fa"), partitions=2)
    back = R.fasta_alignments(R.read_fasta(spark, str(tmp_path / "fa"), "part-*"), region_in_title=True)
    cols = ("region_id", "chrom", "start", "end", "species", "seq")
    assert rows(back, *cols) == rows(aln, *cols)
