"""Parameters of a warehouse run, and the fixed business values.

``as_of`` replaces every "today" of the original design so that a run is
reproducible; all thresholds and vocabularies are parameters with the
business defaults below.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# These must equal the business rules being reproduced.
# ---------------------------------------------------------------------------
# French day names, Monday first (calendar style A).
DAY_NAMES_FR = ["Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi", "Dimanche"]
# French month names, January first (calendar style A).
MONTH_NAMES_FR = ["Janvier", "Février", "Mars", "Avril", "Mai", "Juin", "Juillet",
                  "Août", "Septembre", "Octobre", "Novembre", "Décembre"]
# Fixed public holidays (month-day), repeated each year of calendar style A.
HOLIDAYS_MM_DD = ["01-01", "03-08", "05-01", "08-05", "03-06", "12-25"]
# Price bands (low, high) per country; any other country uses DEFAULT_PRICE_BAND.
PRICE_BANDS = {"Burkina Faso": (10000.0, 25000.0)}
DEFAULT_PRICE_BAND = (70.0, 175.0)
PRICE_LABELS = ("Économique", "Standard", "Premium")
# Cities treated as urban (zone_type), large and medium cities (population_zone).
URBAN_CITIES = ["Ouagadougou", "Accra", "Kumasi"]
LARGE_CITIES = ["Ouagadougou", "Accra"]
MEDIUM_CITIES = ["Bobo-Dioulasso", "Kumasi"]
ZONE_LABELS = ("Urbain", "Péri-urbain")
POPULATION_LABELS = ("Grande ville", "Ville moyenne", "Petite ville")
# Time zone by country; every other country gets DEFAULT_TIMEZONE.
TIMEZONES = {"Burkina Faso": "Africa/Ouagadougou"}
DEFAULT_TIMEZONE = "Africa/Accra"
DEFAULT_CONTINENT = "Afrique de l'Ouest"
# Text fills and labels.
UNKNOWN = "Inconnu"
NOT_PROVIDED = "Non renseigné"
ANONYMISED = "ANONYMISE"
# Event vocabulary.
CALL_TYPES = ["Appel_Sortant", "Appel_Entrant"]
SMS_TYPES = ["SMS_Sortant", "SMS_Entrant"]
DATA_TYPE = "Data"
STATUS_FAILED = "Échec"
SEVERITY_HIGH = "Élevé"
SEVERITY_MEDIUM = "Moyen"
# Seasons: wet season months (style A: June-September, style B: June-October).
WET_SEASON = "Hivernage"
DRY_SEASON = "Saison sèche"
# Time-of-day bands by hour: [0,6) Nuit, [6,12) Matin, [12,18) Après-midi, [18,24) Soir.
HOUR_BANDS = [(0, "Nuit"), (6, "Matin"), (12, "Après-midi"), (18, "Soir")]
# Age bands: upper bound (exclusive) -> label; ages >= 50 are "50+".
AGE_BANDS = [(25, "16-24"), (35, "25-34"), (50, "35-49")]
AGE_OLDEST = "50+"
AGE_MIN, AGE_MAX = 14, 100
# Inactivity default for subscribers without any activity.
NO_ACTIVITY_DAYS = 999

# Labels of the list at risk, and the columns that it shows first.
RISK_LABELS = {"subscriber_id": "Abonné", "risque_churn_pct": "Risque de churn (%)", "days_since_active": "Jours sans activité",
               "failed_calls": "Appels échoués", "network_incidents": "Incidents réseau", "country": "Pays", "segment": "Segment",
               "age": "Âge", "monthly_fee": "Forfait mensuel", "snapshot_month": "Mois"}
RISK_FIRST = ["subscriber_id", "risque_churn_pct", "days_since_active", "failed_calls", "network_incidents"]
# Audit texts of an erasure.
ERASURE = {"column_name": "RGPD_PSEUDONYMISATION", "old_value": "Données identifiantes", "new_value": "Anonymisées sur demande RGPD"}


@dataclass(frozen=True)
class WarehouseConfig:
    """Run parameters. Dates are ISO strings, used as SQL literals."""

    as_of: str = "2001-12-31"
    # calendar span; None: the whole years that the feeds' dates fall in
    calendar_start: str | None = None
    calendar_end: str | None = None
    # years that a date of a feed may fall in; others are rejected, so that one
    # impossible date can't stretch the calendar
    valid_years: tuple = (1900, 2100)
    # number of monthly snapshots: the complete months before the month of as_of
    snapshot_count: int = 7
    churn_risk_days: int = 60
    # "tower": location of a usage event = tower city + tower country;
    # "subscriber": tower city + subscriber country (original behaviour).
    usage_country_from: str = "tower"
    sms_types: tuple = tuple(SMS_TYPES)
    price_bands: dict = field(default_factory=lambda: dict(PRICE_BANDS))
    default_price_band: tuple = DEFAULT_PRICE_BAND
    urban_cities: tuple = tuple(URBAN_CITIES)
    large_cities: tuple = tuple(LARGE_CITIES)
    medium_cities: tuple = tuple(MEDIUM_CITIES)


    @property
    def snapshot_months(self) -> tuple:
        """Months of the monthly snapshot, oldest first (the last one is the
        model's test month)."""
        year, month = int(self.as_of[:4]), int(self.as_of[5:7])
        months = [divmod(year * 12 + month - 1 - k, 12) for k in range(self.snapshot_count, 0, -1)]
        return tuple(f"{y:04d}-{m + 1:02d}" for y, m in months)


DEFAULT_CONFIG = WarehouseConfig()
