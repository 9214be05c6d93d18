"""All registered queries; importing the pair modules fills the two tables."""

from checks import pairs_clusters, pairs_reports, pairs_tables, pairs_text, pairs_vectors  # noqa: F401
from checks.twins import ORACLES, QUERIES  # noqa: F401
