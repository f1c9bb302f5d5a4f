"""FASTA entries and WIG blocks that are cut by file splits anywhere, against plain reading."""

import random

import pytest

from basetide.operators import alignment
from basetide.sources import carried
from basetide.sources import readers as R


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "150", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k in names:
        spark.conf.unset(k)


def plain_fasta(text):
    out = []
    for line in text.splitlines():
        if line.startswith(">"):
            out.append([line[1:].strip(), ""])
        elif out:
            out[-1][1] += "".join(line.split())
    return out


@pytest.mark.parametrize("splits", [200_000, 0])
def test_genome_pieces_over_file_splits(spark, tmp_path, small_splits, splits, monkeypatch):
    monkeypatch.setattr(carried, "SPLITS", splits)
    rng, texts = random.Random(3), {}
    for f in range(3):
        parts = []
        for k in range(rng.randrange(1, 6)):
            seq = "".join(rng.choice("ACGTN") for _ in range(rng.choice([0, 1, 59, 60, 61, 700]) if k else 2000))
            lines = [seq[i:i + 60] for i in range(0, len(seq), 60)]
            parts.append("\n".join([f">chr{k} {'long title ' * rng.randrange(3)}", *lines, *[""] * rng.randrange(2)]))
        texts[f"g{f}.fa"] = ("\r\n" if f == 1 else "\n").join(parts) + "\n"
        (tmp_path / f"g{f}.fa").write_bytes(texts[f"g{f}.fa"].encode())
    df = R.read_genome(spark, str(tmp_path), 97)
    assert carried._lines(spark, [str(tmp_path)]).rdd.getNumPartitions() > 30
    got = sorted((r.file.rsplit("/", 1)[1], r.record, r.title, r.chunk_no, r.seq) for r in df.collect())
    want = sorted((name, n, title, k, seq[k * 97:(k + 1) * 97]) for name, text in texts.items()
                  for n, (title, seq) in enumerate(plain_fasta(text.replace("\r\n", "\n")), 1) for k in range(-(-len(seq) // 97)))
    assert got == want


def test_text_in_front_of_a_title_is_an_error(spark, tmp_path):
    (tmp_path / "x.fa").write_text("ACGT\n>a\nAC\n")
    with pytest.raises(Exception, match="in front of the first title"):
        R.read_genome(spark, str(tmp_path)).collect()


def test_wig_blocks_over_file_splits(spark, tmp_path, small_splits):
    rng, lines, want = random.Random(5), ["track type=wiggle_0", "# note"], []
    for k in range(12):
        step = rng.choice([None, 1, 3])
        start = rng.randrange(1, 1000)
        lines.append(f"fixedStep chrom=c{k % 3} start={start}" + (f" step={step}" if step else ""))
        for j in range(rng.choice([0, 1, 5, 120])):
            v = round(rng.uniform(-9, 9), 3)
            want.append((f"c{k % 3}", start - 1 + j * (step or 1), v))
            lines.append(str(v))
            if rng.random() < 0.1:
                lines.append(rng.choice(["", "#x", "   "]))
    (tmp_path / "a.wig").write_text("\n".join(lines) + "\n")
    got = R.read_wig_fixedstep(spark, str(tmp_path / "a.wig"))
    assert sorted((r.chrom, r.start, r.score) for r in got.collect()) == sorted(want)
    assert all(r.end == r.start + 1 for r in got.collect())


def test_several_values_on_a_line(spark, tmp_path):
    (tmp_path / "a.wig").write_text("fixedStep chrom=c start=5 step=2\n1 2\n 3\t4 \n5\n")
    assert [(r.start, r.score) for r in R.read_wig_fixedstep(spark, str(tmp_path / "a.wig")).orderBy("start").collect()] == [
        (4, 1.0), (6, 2.0), (8, 3.0), (10, 4.0), (12, 5.0)]


def test_slices_of_pieces_from_files(spark, tmp_path, small_splits):
    seq = "".join(random.Random(1).choice("acgtN") for _ in range(1500))
    (tmp_path / "g.fa").write_text(">c1\n" + "\n".join(seq[i:i + 50] for i in range(0, 1500, 50)) + "\n")
    genome = R.read_genome(spark, str(tmp_path), 64).withColumnRenamed("title", "chrom")
    spans = [(0, 1), (63, 65), (10, 700), (1400, 1500)]
    regions = spark.createDataFrame([("c1", s, e) for s, e in spans], "chrom string, start long, end long")
    got = {(r.start, r.end): r.genome_seq for r in alignment.genome_slice(regions, genome, 64).collect()}
    assert got == {(s, e): seq[s:e] for s, e in spans}
    row = spark.createDataFrame([("c1", seq)], "title string, seq string")
    assert [r.seq for r in alignment.chunk_genome(row, 64).orderBy("chunk_no").collect()] == [seq[i:i + 64] for i in range(0, 1500, 64)]
