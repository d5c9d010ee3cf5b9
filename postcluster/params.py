"""Parameters of the clustering job.

The fixed values below must equal the original job's settings for the
results to agree: the language list (its order is the language index),
the spread between languages on the x axis, the number of clusters, the
convergence threshold, the iteration cap, the spread below which the
sample ignores languages, and the layout of the text report.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values (must equal the original job's defaults)
# ---------------------------------------------------------------------------
LANGUAGES: tuple[str, ...] = (
    "JavaScript", "Java", "PHP", "Python", "C#", "C++", "Ruby", "CSS",
    "Objective-C", "Perl", "Scala", "Haskell", "MATLAB", "Clojure", "Groovy",
)
LANG_SPREAD = 50000
KMEANS_KERNELS = 45
KMEANS_ETA = 20.0
KMEANS_MAX_ITERATIONS = 120
GLOBAL_SAMPLE_SPREAD_LIMIT = 500  # spread below this samples regardless of language
GLOBAL_SAMPLE_SEED = 42
REPORT_HEADER: tuple[str, ...] = (
    "Resulting clusters:",
    "  Score  Dominant language (%percent)  Questions",
    "================================================",
)
REPORT_LINE_FORMAT = "%7d  %-17s (%-5.1f%%)      %7d"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class ClusterParams:
    """Knobs of the job; every one can be overridden per call."""

    langs: tuple[str, ...] = LANGUAGES
    spread: int = LANG_SPREAD
    kernels: int = KMEANS_KERNELS
    eta: float = KMEANS_ETA
    max_iterations: int = KMEANS_MAX_ITERATIONS
    seed: int = GLOBAL_SAMPLE_SEED

    def __post_init__(self) -> None:
        if self.spread <= 0:
            raise ValueError("spread must be > 0, or the language cannot be recovered from x")
        if not self.langs:
            raise ValueError("the language list is empty")
        if self.kernels <= 0:
            raise ValueError("kernels must be > 0")
        if self.max_iterations <= 0:
            raise ValueError("max_iterations must be > 0")

    @property
    def per_language(self) -> int:
        """Sample size per language; kernels must split evenly over languages."""
        if self.kernels % len(self.langs) != 0:
            raise ValueError(
                f"kernels ({self.kernels}) must be a multiple of the number of "
                f"languages ({len(self.langs)})"
            )
        return self.kernels // len(self.langs)

    @property
    def samples_by_language(self) -> bool:
        return self.spread >= GLOBAL_SAMPLE_SPREAD_LIMIT


DEFAULT_PARAMS = ClusterParams()

# Spread 1 puts all languages next to each other on x, so clusters mix
# languages, and (spread < 500) the sample ignores languages.  Used by the
# mixed-cluster queries.
MIXED_PARAMS = ClusterParams(spread=1)
