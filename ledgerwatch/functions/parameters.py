"""Labels of rows that lack a value."""

from __future__ import annotations

# Labels of rows without a name or a country.
UNKNOWN_ACTOR = "Acteur non identifié"
UNKNOWN_COUNTRY = "Non identifié"
OTHER = "Autres"
