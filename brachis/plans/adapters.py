"""External programs as partition-level work: one row a unit, its files in a temporary folder of the task's own."""

from __future__ import annotations

import os
import shutil
import subprocess
import tempfile
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: An aligner's flags by mode; another mode is passed on as it stands.
ALIGN_MODES = {
    "auto": ["--auto"],
    "ginsi": ["--globalpair", "--maxiterate", "1000"],
    "linsi": ["--localpair", "--maxiterate", "1000"],
    "einsi": ["--genafpair", "--maxiterate", "1000"],
    "fftns": ["--fftns"],
    "fftnsi": ["--fftnsi"],
}
#: Columns of a protein search's table.
SEARCH_COLUMNS = ("query", "target", "identity", "length", "mismatches", "gaps", "query_start", "query_end", "target_start", "target_end", "evalue", "bitscore")


#: A folder of programs on the driver and every executor, searched before the usual ones.
PROGRAMS = "BRACHIS_PROGRAMS"


def _search_path(own: str | None) -> str:
    return os.pathsep.join(filter(None, [own, os.environ.get("PATH", os.defpath)]))


def missing(programs: list[str]) -> list[str]:
    """Those of the programs that are not installed (as the driver sees it)."""
    return [p for p in programs if shutil.which(p, path=_search_path(os.environ.get(PROGRAMS))) is None]


def run_external(units: DataFrame, key: str, inputs: dict[str, str], command: Callable[[str], list], output: str | None = None, timeout: float = 86_400, tasks: int | None = None) -> DataFrame:
    """(key, output, error): runs a command for each row and returns a file that it leaves.

    ``inputs`` names a file for each text column; ``command`` gets the folder and gives an argument list, or several to be
    run one after another. Without ``output`` the last command's standard output is returned. What fails gives a row with
    null output and the end of its messages, so one unit's failure costs no other its result. Units are dealt to ``tasks``
    tasks by their key, else to as many as there are shuffle partitions, as a unit may take hours.
    """

    own = os.environ.get(PROGRAMS)

    def unit(row, folder: str) -> tuple[str | None, str | None]:
        for column, name in inputs.items():
            with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
                f.write(row[column] or "")
        given, env = command(folder), os.environ | {"PATH": _search_path(own)}
        for argv in given if isinstance(given[0], list) else [given]:
            done = subprocess.run(argv, cwd=folder, capture_output=True, timeout=timeout, check=False, env=env)
            if done.returncode:
                return None, (done.stderr.decode("utf-8", "replace") or f"exit code {done.returncode}")[-1000:]
        if output is None:
            return done.stdout.decode("utf-8", "replace"), None
        path = os.path.join(folder, output)
        if not os.path.exists(path):
            return None, (done.stderr.decode("utf-8", "replace") or "no output")[-1000:]
        with open(path, encoding="utf-8") as f:
            return f.read(), None

    def run(batches):
        for batch in batches:
            rows = []
            for _, row in batch.iterrows():
                with tempfile.TemporaryDirectory() as folder:
                    try:
                        rows.append((str(row[key]), *unit(row, folder)))
                    except (OSError, subprocess.TimeoutExpired) as e:
                        rows.append((str(row[key]), None, str(e)))
            yield pd.DataFrame(rows, columns=[key, "output", "error"])

    tasks = tasks or int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return units.select(key, *inputs).repartition(tasks, key).mapInPandas(run, f"{key} string, output string, error string")


def press(profiles: str, program: str = "hmmpress") -> list[str]:
    return [program, "-f", profiles]


def profile_search(program: str, profiles: str, sequences: str, table: str) -> list[str]:
    return [program, "--cpu", "1", "--domtblout", table, profiles, sequences]


def profile_scan(profiles: str, sequences: str, table: str) -> list[list[str]]:
    """A scan reads a pressed database, so each unit's is pressed in its own folder."""
    return [press(profiles), profile_search("hmmscan", profiles, sequences, table)]


def profile_align(profile: str, sequences: str, trimmed: bool = True) -> list[list[str]]:
    """Align to a profile, then print the alignment as FASTA."""
    return [["hmmalign", *(["--trim"] if trimmed else []), "--outformat", "stockholm", "-o", "aligned.sto", profile, sequences], ["esl-reformat", "afa", "aligned.sto"]]


def align(mode: str, sequences: str, threads: int = 1) -> list[str]:
    """Prints the alignment."""
    return ["mafft", *ALIGN_MODES.get(mode, mode.split()), "--thread", str(threads), "--quiet", sequences]


def tree(program: str, alignment: str, prefix: str, boot: int = 1000, threads: int = 1, states: bool = True) -> list[str]:
    return [program, "-s", alignment, "-m", "MFP", "-B", str(boot), "-T", str(threads), "-pre", prefix, *(["-asr"] if states else []), "-quiet"]


def trim(alignment: str, out: str) -> list[str]:
    return ["clipkit", alignment, "-o", out]


def codon_alignment(program: str, proteins: str, cds: str) -> list[str]:
    """Prints the alignment."""
    return [*program.split(), proteins, cds, "-output", "fasta"]


def selection_test(program: str, test: str, alignment: str, tree_file: str, out: str) -> list[str]:
    return [program, test, "--alignment", alignment, "--tree", tree_file, "--output", out]


def protein_search(method: str, sequences: str, settings: dict | None = None) -> list:
    """All proteins of a file against each other; prints a table of ``SEARCH_COLUMNS``."""
    own = {"max_evalue": 1e-5, "max_targets": 2000, "diamond_bin": "diamond", "mmseqs_bin": "mmseqs"} | (settings or {})
    evalue, targets = str(own["max_evalue"]), str(own["max_targets"])
    if method in ("mmseqs", "mmseqs2"):
        return [[own["mmseqs_bin"], "easy-search", sequences, sequences, "found.tsv", "work", "-e", evalue, "--max-seqs", targets, "--format-output", "query,target,pident,alnlen,mismatch,gapopen,qstart,qend,tstart,tend,evalue,bits", "-v", "0"], ["cat", "found.tsv"]]
    if method == "diamond":
        return [[own["diamond_bin"], "makedb", "--in", sequences, "-d", "proteins", "--quiet"], [own["diamond_bin"], "blastp", "-q", sequences, "-d", "proteins", "-e", evalue, "-k", targets, "--outfmt", "6", "--quiet"]]
    return ["blastp", "-query", sequences, "-subject", sequences, "-evalue", evalue, "-max_target_seqs", targets, "-outfmt", "6"]


def search_table(printed: DataFrame, key: str = "hmm") -> DataFrame:
    """(key, query, target, identity, ..., bitscore) of what protein searches print."""
    lines = printed.where(F.col("output").isNotNull()).select(key, F.explode(F.split("output", r"\r?\n")).alias("line"))
    fields = lines.select(key, F.split("line", "\t").alias("f")).where(F.size("f") >= len(SEARCH_COLUMNS))
    kinds = {"query": "string", "target": "string", "identity": "double", "evalue": "double", "bitscore": "double"}
    return fields.select(key, *(F.get("f", F.lit(k)).try_cast(kinds.get(n, "int")).alias(n) for k, n in enumerate(SEARCH_COLUMNS)))
