"""The command line end to end on a small made-up sample."""

import json
import random

from chemprobe import cli

REF = "ACGTTGCAACGGATCCGATACATTGACCGTAGGATCCATGAAGTCTAGGA"


def test_sam_to_document(spark, tmp_path):
    rng = random.Random(1)
    (tmp_path / "r.fa").write_text(f">r1\n{REF}\n")
    (tmp_path / "library.csv").write_text("reference,section_start,section_end,section,family\nr1,11,30,roi,fam\n")
    (tmp_path / "samples.csv").write_text("sample,user,exp_env\ns1,me,in_vitro\n")
    lines = []
    for k in range(40):
        at = rng.choice([i for i, b in enumerate(REF) if b in "AC"])
        read = REF[:at] + "ACGT"[("ACGT".index(REF[at]) + 1) % 4] + REF[at + 1 :]
        lines.append(f"q{k}\t0\tr1\t1\t42\t50M\t*\t0\t0\t{read}\t{'I' * 50}")
    (tmp_path / "s.sam").write_text("\n".join(lines) + "\n")
    common = ["--fasta", f"{tmp_path}/r.fa", "--library", f"{tmp_path}/library.csv"]
    cli.main(["vectorize", "--sam", f"{tmp_path}/s.sam", *common, "--out", f"{tmp_path}/v"])
    cli.main(["aggregate", "--vectors", f"{tmp_path}/v", *common, "--samples", f"{tmp_path}/samples.csv", "--sample", "s1", "--out", f"{tmp_path}/doc"])
    doc = json.loads(spark.read.text(f"{tmp_path}/doc/sample=s1").first()["value"])
    assert doc["user"] == "me" and doc["r1"]["family"] == "fam"
    full, roi = doc["r1"]["full"], doc["r1"]["roi"]
    assert full["sequence"] == REF and full["pop_avg"]["cov"] == [40] * 50 and roi["pop_avg"]["cov"] == [40] * 20
    assert sum(full["pop_avg"]["sub_N"]) == 40 and roi["pop_avg"]["sub_N"] == full["pop_avg"]["sub_N"][10:30]
    cli.main(["cluster", "--vectors", f"{tmp_path}/v", *common, "--ref", "r1", "--section", "full", "--min-reads", "5", "--max-clusters", "2", "--num-runs", "1", "--out", f"{tmp_path}/m.csv"])
    assert spark.read.csv(f"{tmp_path}/m.csv", header=True).count() > 5
