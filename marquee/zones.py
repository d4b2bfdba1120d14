"""Storage layout and the contract of each dataset."""

from __future__ import annotations

from dataclasses import dataclass, field

LANDING, RAW, CURATED = "landing", "raw", "curated"


@dataclass(frozen=True)
class Zones:
    """``<root>/<zone>/<catalogue>/<name>`` on any Hadoop file system. With a ``generation`` the raw and curated
    datasets are those of one run, in a folder of that name before ``<name>``."""

    root: str
    catalogue: str = "films"
    generation: str | None = None

    def path(self, zone: str, name: str | None = None) -> str:
        if zone not in (LANDING, RAW, CURATED):
            raise ValueError(f"unknown zone {zone!r}")
        base = f"{self.root.rstrip('/')}/{zone}/{self.catalogue}"
        if self.generation and zone != LANDING:
            base += f"/{self.generation}"
        return f"{base}/{name}" if name else base

    @property
    def manifest(self) -> str:
        """Where the published generations are listed."""
        return f"{self.root.rstrip('/')}/manifest/{self.catalogue}"


@dataclass(frozen=True)
class LandingFile:
    """What a landing file must hold and how its text columns are typed."""

    file: str
    required: tuple[str, ...]
    casts: dict[str, str] = field(default_factory=dict)
    splits: dict[str, str] = field(default_factory=dict)


# File names, column names and column types of the film catalogue.
LANDING_FILES = {
    "title_basics": LandingFile(
        "title.basics.tsv",
        ("tconst", "titleType", "primaryTitle", "startYear", "endYear", "runtimeMinutes", "genres"),
        casts={"startYear": "int", "endYear": "int", "runtimeMinutes": "int"},
        splits={"genres": "genres_array"},
    ),
    "title_ratings": LandingFile(
        "title.ratings.tsv",
        ("tconst", "averageRating", "numVotes"),
        casts={"averageRating": "double", "numVotes": "bigint"},
    ),
    "name_basics": LandingFile(
        "name.basics.tsv",
        ("nconst", "primaryName", "primaryProfession", "knownForTitles"),
        splits={"knownForTitles": "knownForArray"},
    ),
}

CURATED_DATASETS = (
    "title_with_ratings_nopartition",
    "title_by_genre",
    "genre_stats",
    "title_popularity",
    "person_rating_summary",
    "title_by_decade",
)
