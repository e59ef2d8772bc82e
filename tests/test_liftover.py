"""Chain parsing, genome chunks and liftover."""

import random

import pytest

from basewise.operators import lift_positions
from basewise.sources import parse_chains, read_chain, read_genome_chunks

VARIANT = "chromosome_id string, position int, ref string, alt string"
COMP = str.maketrans("ACGT", "TGCA")


def write_genome(path, contigs, width=60):
    with open(path, "w") as f:
        for name, bases in contigs.items():
            f.write(f">{name} some text\n")
            f.writelines(bases[i : i + width] + "\n" for i in range(0, len(bases), width))


def bases(n, seed):
    rng = random.Random(seed)
    return "".join(rng.choice("ACGTacgt") for _ in range(n))


@pytest.mark.parametrize("width", [7, 60, 100000])
@pytest.mark.parametrize("split", ["700", "134217728"])
def test_genome_chunks(spark, tmp_path, width, split):
    contigs = {"chr1": bases(2345, 1), "chr2": bases(100, 2), "chrX": bases(99, 3), "empty": "", "chrY": bases(1, 4)}
    write_genome(tmp_path / "g.fa", contigs, width)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        rows = read_genome_chunks(spark, str(tmp_path / "g.fa"), chunk=100).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    expected = {(n, i // 100): b[i : i + 100] for n, b in contigs.items() for i in range(0, len(b), 100)}
    assert {(r.chr, r.chunk_id): r.bases for r in rows} == expected and len(rows) == len(expected)


def random_chain(rng, number, src, src_size, dst, dst_size):
    """Chain text and its blocks as (src0, dst0, size), coordinates 0-based along each strand."""
    strand = rng.choice("+-")
    s, d = rng.randrange(0, 200), rng.randrange(0, 200)
    start_s, start_d, lines, blocks = s, d, [], []
    for k in range(rng.randrange(1, 12)):
        size = rng.randrange(1, 80)
        blocks.append((s, d, size))
        dt, dq = rng.choice([(0, 5), (7, 0), (4, 9)])
        lines.append((size, dt, dq))
        s, d = s + size + dt, d + size + dq
    end_s, end_d = s - lines[-1][1], d - lines[-1][2]
    body = "\n".join("\t".join(map(str, x)) for x in lines[:-1])
    body = (body + "\n" if body else "") + str(lines[-1][0])
    score = rng.randrange(1, 10**6)
    head = f"chain {score} {src} {src_size} + {start_s} {end_s} {dst} {dst_size} {strand} {start_d} {end_d} {number}"
    return score, strand, f"{head}\n{body}\n\n", blocks, lines


@pytest.mark.parametrize(("limit", "multi"), [(None, True), (None, False), (0, False)])
def test_liftover_against_walk(spark, tmp_path, limit, multi):
    rng = random.Random(21)
    size = 3000
    genome = {f"chr{i}": bases(size, 50 + i).upper() for i in range(1, 4)}
    write_genome(tmp_path / "g.fa", genome)
    chains = []
    for i in range(12):
        src, dst = f"chr{rng.randrange(1, 4)}", f"chr{rng.randrange(1, 5)}"
        chains.append((src, dst, *random_chain(rng, i, src, size, dst, size), i))
    (tmp_path / "c.chain").write_text("".join(c[4] for c in chains))
    blocks = read_chain(spark, str(tmp_path / "c.chain"))
    assert blocks.count() == sum(len(c[5]) for c in chains)
    points = [(str(rng.randrange(1, 5)), rng.randrange(1, 1200), rng.choice("ACGT"), "N") for _ in range(3000)]
    points += [(None, -1, "A", "C"), ("1", -1, "A", "C"), ("chr2", 100, "A", "C")]

    def expected(chrom, p, ref, alt):
        if chrom is None:
            return ("None", -1, "None", "None", "Unknown", "None")
        contig = chrom if chrom.startswith("chr") else "chr" + chrom
        kept = (contig[3:], p, ref, alt)
        hits = []
        for src, dst, score, strand, _, bl, _, number in chains:
            hits += [
                (-score, str(number), dst, strand, d + (p - 1 - s))
                for s, d, n in bl
                if src == contig and s <= p - 1 < s + n
            ]
        if not hits:
            return (*kept, "NO_TARGET", ".")
        _, _, dst, strand, q = min(hits)
        if dst not in genome:
            return (*kept, "NO_TARGET", ".")
        new_ref, new_alt = (ref, alt) if strand == "+" else (ref.translate(COMP), alt.translate(COMP))
        at = q + 1 if strand == "+" else size - q
        if genome[dst][at - 1] != new_ref:
            return (*kept, "MISMATCHING_REF_ALLELE", f"AttemptedLocus={dst}:{at}-{at}")
        return (dst[3:], at, new_ref, new_alt, "PASS", f"OriginalContig={contig};OriginalStart={p}")

    chunks = read_genome_chunks(spark, str(tmp_path / "g.fa"), chunk=100)
    df = spark.createDataFrame(points, VARIANT)
    rows = lift_positions(df, blocks, chunks, chunk=100, bin_width=64, broadcast_limit=limit, multi_base=multi).collect()
    got = sorted(str((tuple(r)[:4], tuple(r)[4:])) for r in rows)
    assert got == sorted(str((pt, expected(*pt))) for pt in points)
    results = {r.liftoverResult for r in rows}
    assert results == {"PASS", "NO_TARGET", "MISMATCHING_REF_ALLELE", "Unknown"}


def test_longer_alleles(spark):
    blocks = spark.createDataFrame(
        [
            ("chr1", 1, 10, "chr9", 101, "+", 500, 5, "a", 20),
            ("chr1", 11, 20, "chr9", 121, "+", 500, 5, "a", 20),  # target hole in front, no source hole
            ("chr1", 31, 40, "chr9", 141, "+", 500, 5, "a", 40),  # source hole in front
            ("chr2", 1, 50, "chr9", 11, "-", 500, 5, "b", 50),
        ],
        "src_chr string, src_start long, src_end long, dst_chr string, dst_start long, dst_strand string, "
        "dst_size long, score long, chain_id string, src_run_end long",
    )
    df = spark.createDataFrame(
        [("1", 9, "AC", "GT"), ("1", 10, "AC", "GT"), ("1", 19, "ACG", "A"), ("2", 5, "AC", "GG"), ("2", 5, "AC", "G")],
        VARIANT,
    )
    got = [tuple(r)[4:9] for r in lift_positions(df, blocks).collect()]
    assert got == [
        ("9", 109, "AC", "GT", "PASS"),
        ("1", 10, "AC", "GT", "INDEL_STRADDLES_TWO_INTERVALS"),
        ("1", 19, "ACG", "A", "NO_TARGET"),
        ("9", 485, "GT", "CC", "PASS"),
        ("2", 5, "AC", "G", "CANNOT_LIFTOVER_INDEL"),
    ]
    genome = spark.createDataFrame([("chr9", 10, "TTTTTTTTTa"), ("chr9", 11, "cTTTTTTTTT")], "chr string, chunk_id long, bases string")
    crossing = spark.createDataFrame([("1", 10, "ac", "GT")], VARIANT)
    wide = blocks.where("src_chr = 'chr1' and src_start = 1").selectExpr(
        "src_chr", "src_start", "50L as src_end", "dst_chr", "dst_start", "dst_strand", "dst_size"
    )
    row = lift_positions(crossing, wide, genome, chunk=10, multi_base=True).first()
    assert (row.position_hg19, row.liftoverResult) == (110, "PASS")
    # One lazy plan compares no allele that reaches over a chunk, and fails no job.
    single = lift_positions(crossing, wide, genome, chunk=10, multi_base=False).first()
    assert (single.position_hg19, single.liftoverResult) == (10, "CANNOT_LIFTOVER_INDEL")


def turned(text):
    return text.translate(COMP)[::-1]


def lift_whole(genome, chains, chrom, p, ref, alt):
    """One variant lifted by walking the chains, moved left base by base."""
    if chrom is None:
        return ("None", -1, "None", "None", "Unknown", "None")
    kept, n = (chrom, p, ref, alt), len(ref)
    best = None
    for src, dst, score, strand, _, blocks, _, number in chains:
        if src != "chr" + chrom:
            continue
        where = {}
        for s, d, size in blocks:
            where.update((s + i, d + i) for i in range(size))
        if p >= 1 and all(p - 1 + i in where for i in range(n)):
            key = (-score, str(number))
            if best is None or key < best[0]:
                best = (key, dst, strand, where[p - 1], where[p + n - 2])
    if best is None:
        return (*kept, "NO_TARGET", ".")
    _, dst, strand, first, last = best
    if last - first + 1 != n:
        return (*kept, "INDEL_STRADDLES_TWO_INTERVALS", ".")
    alts = alt.split(",")
    grows = any(len(a) != n for a in alts)
    if strand == "-" and grows and len(alts) > 1:
        return (*kept, "CANNOT_LIFTOVER_INDEL", ".")
    if dst not in genome:
        return (*kept, "NO_TARGET", ".")
    text = genome[dst].upper()
    if strand == "+":
        at, new_ref, new_alt = first + 1, ref, alt
    else:
        at, new_ref, new_alt = len(text) - last, turned(ref), ",".join(map(turned, alts))
        if grows:
            r, a = new_ref, new_alt
            while True:
                if r and a and r[-1] == a[-1]:
                    r, a = r[:-1], a[:-1]
                elif not r or not a:
                    if at > 1:
                        r, a, at = text[at - 2] + r, text[at - 2] + a, at - 1
                        if r[-1] != a[-1]:
                            break
                    else:
                        behind = text[len(r)]
                        r, a = r + behind, a + behind
                        break
                else:
                    break
            while len(r) > 1 and len(a) > 1 and r[0] == a[0]:
                r, a, at = r[1:], a[1:], at + 1
            new_ref, new_alt = r, a
    if text[at - 1 : at - 1 + len(new_ref)] != new_ref.upper():
        return (*kept, "MISMATCHING_REF_ALLELE", f"AttemptedLocus={dst}:{at}-{at + len(new_ref) - 1}")
    return (dst[3:], at, new_ref, new_alt, "PASS", f"OriginalContig=chr{chrom};OriginalStart={p}")


@pytest.mark.parametrize("chunk", [5, 16, 1000])
def test_whole_alleles_against_walk(spark, tmp_path, chunk):
    """Alleles over many chunks, repeats over chunk borders and to the contig's begin, all six results."""
    rng = random.Random(chunk)
    size = 400
    genome = {}
    for i in range(1, 4):
        text = ""
        while len(text) < size:
            unit = "".join(rng.choice("ACGT") for _ in range(rng.randrange(1, 4)))
            text += unit * rng.randrange(1, 25)
        genome[f"chr{i}"] = "".join(rng.choice([c, c.lower()]) for c in text[:size])
    write_genome(tmp_path / "g.fa", genome)
    chains = []
    for i in range(14):
        src, dst = f"chr{rng.randrange(1, 4)}", f"chr{rng.choice([1, 2, 3, 3, 4])}"
        strand, s, d, blocks, lines = rng.choice("+--"), rng.randrange(0, 120), rng.randrange(0, 60), [], []
        for _ in range(rng.randrange(1, 7)):
            width = rng.randrange(1, 60)
            blocks.append((s, d, width))
            lines.append((width, *rng.choice([(0, 5), (7, 0), (0, 0), (0, 0), (4, 9)])))
            s, d = s + width + lines[-1][1], d + width + lines[-1][2]
        if s > size or d > size:
            continue
        body = "\n".join("\t".join(map(str, x)) for x in lines[:-1])
        body = (body + "\n" if body else "") + str(lines[-1][0])
        score = rng.randrange(1, 4)
        head = f"chain {score} {src} {size} + {blocks[0][0]} {s} {dst} {size} {strand} {blocks[0][1]} {d} {i}"
        chains.append((src, dst, score, strand, f"{head}\n{body}\n\n", blocks, None, i))
    (tmp_path / "c.chain").write_text("".join(c[4] for c in chains))
    points = [(None, 3, "A", "C"), ("1", 0, "A", "C"), ("1", -5, "AA", "C")]
    for _ in range(1500):
        chain = rng.choice(chains)
        s, d, width = rng.choice(chain[5])
        p = s + rng.randrange(0, width)
        n = rng.choice([1, 1, 2, 3, 5, 12, 40])
        text = genome.get(chain[1], "A" * size).upper()
        at = d + p - s
        ref = text[at : at + n] if chain[3] == "+" else turned(text)[at : at + n]
        if not ref:
            continue
        if rng.random() < 0.1:
            ref = rng.choice("ACGT") + ref[1:]
        alt = rng.choice([ref[0], ref + ref[: rng.randrange(1, 4)], ref[0] + "".join(rng.choice("ACGT") for _ in range(rng.randrange(0, 4))), rng.choice("ACGT"), ref[::-1], ref[0] + "," + ref + "A"])
        points.append((chain[0][3:], p + 1, ref, alt))
    chunks = read_genome_chunks(spark, str(tmp_path / "g.fa"), chunk=chunk)
    rows = lift_positions(spark.createDataFrame(points, VARIANT), read_chain(spark, str(tmp_path / "c.chain")), chunks, chunk=chunk, bin_width=32).collect()
    got = sorted(str((tuple(r)[:4], tuple(r)[4:])) for r in rows)
    assert got == sorted(str((pt, lift_whole(genome, chains, *pt))) for pt in points)
    assert {r.liftoverResult for r in rows} == {
        "PASS", "NO_TARGET", "MISMATCHING_REF_ALLELE", "Unknown", "INDEL_STRADDLES_TWO_INTERVALS", "CANNOT_LIFTOVER_INDEL"
    }


def test_longest_repeat_and_missing_genome(spark):
    """A repeat through many chunks ends at the contig's begin; a genome without the contig's chunks gives a mismatch."""
    unit = "ACG"
    text = unit * 400
    chunks = spark.createDataFrame([("chr9", i, text[i * 10 : i * 10 + 10]) for i in range(120)], "chr string, chunk_id long, bases string")
    blocks = spark.createDataFrame([("chr1", 1, 1200, "chr9", 1, "-", 1200)], "src_chr string, src_start long, src_end long, dst_chr string, dst_start long, dst_strand string, dst_size long")
    source = turned(text)
    df = spark.createDataFrame([("1", 100, source[99:103], source[99]), ("1", 50, source[49], source[49] + source[50:53])], VARIANT)
    got = {(r.position_hg19, r.ref_hg19, r.alt_hg19, r.liftoverResult) for r in lift_positions(df, blocks, chunks, chunk=10).collect()}
    assert got == {(1, "ACGA", "A", "PASS"), (1, "A", "ACGA", "PASS")}
    holes = lift_positions(df, blocks, chunks.where("chunk_id = 0"), chunk=10).collect()
    assert {r.liftoverResult for r in holes} == {"MISMATCHING_REF_ALLELE"}
    assert lift_positions(df.limit(0), blocks, chunks, chunk=10).count() == 0


@pytest.mark.parametrize("split", ["64", "1000", "134217728"])
def test_chain_lines_over_splits(spark, tmp_path, split):
    """Chains read line by line, over any split borders, equal the same text parsed chain by chain."""
    rng = random.Random(3)
    texts = ["##comment\n5 1 1\n\n"]
    for i in range(30):
        texts.append(random_chain(rng, i, f"chr{rng.randrange(1, 4)}", 3000, "chr1", 3000)[2])
    long = "".join(f"{rng.randrange(1, 9)}\t{rng.choice([0, 0, 2])}\t{rng.randrange(0, 3)}\n" for _ in range(3000))
    texts.append(f"chain 77 chrL 90000 + 5 80000 chr2 90000 - 7 80000 long\r\n{long}9\n\n")
    texts.append("chain x chr1 9 + y 9 chr2 9 + 0 9 broken\n5\n\n")
    texts.append(random_chain(rng, 99, "chr1", 3000, "chr2", 3000)[2])
    for name in ("a", "b"):
        (tmp_path / f"{name}.chain").write_text("".join(texts))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = sorted(str(tuple(r)) for r in read_chain(spark, str(tmp_path)).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    records = spark.createDataFrame([(t[6:],) for t in texts if t.startswith("chain") and "broken" not in t], "value string")
    want = [str(tuple(r)) for r in parse_chains(records).collect()]
    assert got == sorted(want * 2)
