"""Parameters of a run, with the pipeline's defaults, and their hashes."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field, fields


@dataclass(frozen=True)
class Config:
    dir_data: str | None = None
    dir_out: str | None = None
    path_ref: str | None = None
    path_trim_patterns: str | None = None
    path_manual_exclusions: str | None = None
    import_patterns: tuple[str, ...] = (r"\.fastq$", r"\.fastq.gz$", r"\.fasta$", r"\.fa$", r"\.bam$")
    import_recursive: bool = True
    r1_pattern: str = "_R1_"
    r2_pattern: str = "_R2_"
    select_one_of_pair: str | None = "R1"
    downsample: int | None = None
    check_duplicate_readnames: bool = True
    trim: bool = True
    trim_max_mismatch: int = 3
    trim_with_indels: bool = True
    align_seed: int = 11
    align_least_score: int = 40
    visualise_alignment: bool = True
    visualise_alignment_downsample: int = 1000
    rpt_pattern: str = "CAG"
    rpt_min_repeats: int = 2
    rpt_max_mismatch: int = 0
    rpt_start_perfect_repeats: int = 2
    rpt_end_perfect_repeats: int = 2
    rpt_max_gap: int = 6
    rpt_max_tract_gap: int = 18
    rpt_return_option: str = "longest"
    repeat_count_method: str = "repeat_count_full"
    na_repeat_handling: str = "convert_to_zero"
    export_read_counts: bool = True
    rm_flank_length_outliers: bool = False
    flank_iqr_multiplier: float = 1.5
    cluster: bool = True
    cluster_by: tuple[str, ...] = ("repeat",)
    repeat_cluster_max: int = 20
    haplotype_cluster_downsample: int = 5000
    haplotype_region: str = "both"
    haplotype_method: str = "levenshtein"
    haplotype_trim_length: str | int | None = "auto"
    cluster_consensus: bool = True
    consensus_threshold: float = 0.5
    consensus_downsample: int = 50
    call_variants: bool = True
    waterfall: bool = True
    waterfall_downsample: int = 1000
    waterfall_per_cluster: bool = False
    path_settings: str | None = None
    range_peak_span: int = 3
    group_control: bool = True
    control_sample_selection: str = "flagged"
    control_setpoint_metric: str = "median_length"
    control_aggregation_method: str = "median"
    repeat_histogram_binwidth: int = 1
    resume: bool = True
    strict_flags: bool = False
    run_modules: tuple[int, ...] = (1, 2, 3, 4, 5, 6, 7)
    dry_run: bool = False

    def digest(self, module: int) -> str:
        """Hash of what a module's output depends on: its own parameters and those of the modules before it."""
        own = {k: v for m in range(1, module + 1) for k, v in self.of(m).items()}
        return hashlib.sha256(json.dumps(own, sort_keys=True, default=str).encode()).hexdigest()

    def of(self, module: int) -> dict:
        return {k: v for k, v in asdict(self).items() if k in MODULE_FIELDS[module]}


MODULE_FIELDS = {
    1: {"dir_data", "path_trim_patterns", "import_patterns", "import_recursive", "r1_pattern", "r2_pattern", "select_one_of_pair", "downsample", "check_duplicate_readnames", "trim", "trim_max_mismatch", "trim_with_indels"},
    2: {"path_ref", "path_manual_exclusions", "align_seed", "align_least_score"},
    3: {f.name for f in fields(Config) if f.name.startswith("rpt_")} | {"repeat_count_method", "na_repeat_handling", "rm_flank_length_outliers", "flank_iqr_multiplier"},
    4: {f.name for f in fields(Config) if f.name.startswith(("cluster", "haplotype", "consensus"))} | {"repeat_cluster_max", "call_variants"},
    5: {"waterfall", "waterfall_downsample", "waterfall_per_cluster"},
    6: {"path_settings", "range_peak_span", "group_control", "control_sample_selection", "control_setpoint_metric", "control_aggregation_method", "strict_flags"},
    7: {"repeat_histogram_binwidth"},
}


@dataclass
class Timing:
    """Seconds of each module; a table with running and whole sums."""

    seconds: dict[str, float] = field(default_factory=dict)

    def table(self) -> list[tuple[str, float, str, float]]:
        total, rows = 0.0, []
        for name, s in self.seconds.items():
            total += s
            rows.append((name, round(s, 3), format_elapsed(s), round(total, 3)))
        return [*rows, ("Total", round(total, 3), format_elapsed(total), round(total, 3))]


def format_elapsed(seconds: float) -> str:
    if seconds < 60:
        return f"{seconds:.1f} s"
    if seconds < 3600:
        return f"{seconds / 60:.1f} min"
    return f"{seconds / 3600:.2f} h"
