# FIXED VALUES
# Word lists, thresholds, labels and texts that decide results.  They are data,
# kept together and in natural order; nothing else in the package repeats them.

# --- geography -------------------------------------------------------------
HOME_COUNTRY = "Côte d'Ivoire"
HOME_HUB = "ABJ"
CONTINENT_ZONES = ("Africa", "Europe", "America", "Asia")

# --- French status words (compared lower-case) -------------------------------
RESOLVED = "résolu"
OPEN = "ouvert"
IN_PROGRESS = "en cours"
RISK_SCORES = {"élevé": 3, "moyen": 2, "faible": 1}
NO_TIER_WORDS = ("none", "null", "")

# --- keyword lists, matched as substrings of the lower-case text -------------
COMPLAINT_KEYWORDS = {
    "refund": ("remboursement", "débité"),
    "baggage": ("bagage", "valise", "sac de voyage"),
    "delay": ("retard", "retardé", "correspondance"),
    "cancellation": ("annulé", "annulation", "sans préavis"),
    "overbooking": ("surréservation", "refusé l'embarquement", "avion était plein"),
    "meal": ("repas", "immangeable", "végétarien"),
    "seat": ("siège", "hublot", "sièges sales"),
    "comfort": ("climatisation", "insupportable"),
    "digital": ("application", "site web", "débité deux fois"),
    "staff": ("personnel", "désagréable", "peu professionnel"),
    "positive": ("très bon", "attentionnée", "service correct"),
}
CRITICAL_KEYWORDS = ("bloqué", "compensation", "correspondance", "remboursement")
PRIMARY_COMPLAINT = (
    ("refund", ("remboursement",)),
    ("baggage", ("bagage", "valise")),
    ("delay", ("retard",)),
    ("cancellation", ("annulé",)),
    ("overbooking", ("surréservation",)),
    ("seat", ("siège",)),
    ("comfort", ("climatisation",)),
    ("digital", ("application", "site web")),
    ("staff", ("personnel",)),
    ("positive", ("très bon",)),
)
ITEM_CATEGORIES = (
    ("baggage", ("bagage",)),
    ("seat", ("siège", "siege")),
    ("meal", ("repas", "meal")),
    ("lounge", ("lounge",)),
    ("insurance", ("assurance",)),
    ("priority", ("priorité", "priority")),
)
PURCHASE_CHANNELS = (
    ("mobile_app", ("mobile", "application")),
    ("web", ("site", "web")),
    ("airport_counter", ("comptoir", "aéroport")),
    ("travel_agency", ("agence", "travel")),
)
PREMIUM_SEAT_WORDS = ("issue de secours", "premium")
SEASONS = (
    ("harmattan", ("harmattan",)),
    ("short_dry_season", ("petite saison sèche",)),
    ("long_dry_season", ("grande saison sèche",)),
    ("short_rainy_season", ("petite saison des pluies",)),
    ("long_rainy_season", ("grande saison des pluies",)),
    ("dry_season", ("saison sèche",)),
    ("rainy_season", ("saison des pluies",)),
)
CARGO_TYPES = (
    ("documents", ("urgent", "document")),
    ("pharmaceutical", ("pharma",)),
    ("perishable", ("périssable", "perishable")),
    ("textile", ("textile",)),
    ("electronics", ("électronique", "electronic")),
)
SENSITIVE_CARGO_WORDS = ("pharma", "périssable")
FLIGHT_EARN_WORDS = ("vol", "gagn")  # both must occur
EARN_CATEGORIES = (
    ("earn_partner", ("partenaire", "hôtel", "hotel")),
    ("earn_bonus", ("bonus", "promotion")),
    ("purchase", ("acheté", "achet")),
    ("redeem", ("utilisé", "utilis", "dépensé")),
    ("expire", ("expiré", "expir")),
)
SPENDING_WORDS = ("utilisé", "dépensé", "expiré")
PURCHASED_MILES_WORDS = ("achet",)
PARTNER_MILES_WORDS = ("partenaire", "hôtel")
BONUS_MILES_WORDS = ("bonus", "promotion")

# --- bands: (bound, name), last entry is the default ---------------------------
GENERATIONS = ((1965, "Baby Boomer"), (1981, "Gen X"), (1997, "Millennial"), (2013, "Gen Z"))
SENTIMENT_BANDS = ((0.5, "positive"), (0.0, "neutral"), (-0.5, "negative"))
SENTIMENT_DEFAULT = "very_negative"
URGENCY_BANDS = ((-0.7, "critical"), (-0.5, "high"), (0.0, "medium"))

# --- cost ranges outside which a cost is suspect --------------------------------
COST_LIMITS = {
    "fuel_cost_usd": ("is_fuel_suspect", 15000),
    "airport_fees_usd": ("is_airport_fees_suspect", 5000),
    "crew_cost_usd": ("is_crew_suspect", 5000),
    "maintenance_cost_usd": ("is_maintenance_suspect", 3000),
    "catering_cost_usd": ("is_catering_suspect", 500),
}

# --- decision labels and recommendations ------------------------------------------
ROUTE_LABELS = {
    "GrowthOpportunity": "🟢 GrowthOpportunity",
    "StrategicUnderperformer": "🔴 StrategicUnderperformer",
    "OperationallyUnprofitable": "🟠 OperationallyUnprofitable",
    "DemandUnprofitable": "⚪ DemandUnprofitable",
    "RouteToDefend": "🔵 RouteToDefend",
    "StableRoute": "🟡 StableRoute",
}
ROUTE_ADVICE = {
    "GrowthOpportunity": "Augmenter fréquence et budget marketing sur cette route",
    "StrategicUnderperformer": "Audit opérationnel urgent — route stratégique en difficulté",
    "OperationallyUnprofitable": "Revoir les coûts opérationnels — la demande est présente",
    "DemandUnprofitable": "Évaluer suspension ou restructuration tarifaire",
    "RouteToDefend": "Améliorer satisfaction client pour contrer la concurrence",
    "StableRoute": "Maintenir le cap — route stable",
}
CUSTOMER_LABELS = {
    "HighValueAtRisk": "🔴 HighValueAtRisk",
    "LoyaltyConversionTarget": "🟢 LoyaltyConversionTarget",
    "PremiumUpgradeCandidate": "🔵 PremiumUpgradeCandidate",
    "AncillaryOfferTarget": "🟡 AncillaryOfferTarget",
    "ReactivationTarget": "⚪ ReactivationTarget",
    "StableCustomer": "✅ StableCustomer",
}
CUSTOMER_ADVICE = {
    "HighValueAtRisk": "Contact prioritaire — offrir geste commercial immédiat",
    "LoyaltyConversionTarget": "Proposer adhésion programme fidélité avec bonus miles",
    "PremiumUpgradeCandidate": "Offrir upgrade Business Class sur prochain vol",
    "AncillaryOfferTarget": "Campagne ciblée bagage + siège premium",
    "ReactivationTarget": "Email réactivation avec offre promotionnelle",
    "StableCustomer": "Maintenir engagement — client stable",
}

# --- vocabulary of the triple view ------------------------------------------------
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
OWL = "http://www.w3.org/2002/07/owl#"
XSD = "http://www.w3.org/2001/XMLSchema#"

BASE_CLASSES = {  # class: label
    "Route": "Route aérienne",
    "Customer": "Client",
    "Airport": "Aéroport",
    "Airline": "Compagnie aérienne",
}
BASE_COMMENTS = {  # class: comment
    "Route": "Équivalent de la table main_marts.dim_routes.",
    "Customer": "Équivalent de la table main_marts.dim_customers.",
    "Airport": "Classe de contexte. Permet hasOrigin et hasDestination.",
    "Airline": "Classe de contexte. Permet hasCompetitor.",
}
CLASS_TEXTS = {  # inferred class: label
    "GrowthOpportunity": "Route à fort potentiel de croissance",
    "StrategicUnderperformer": "Route stratégique sous-performante",
    "OperationallyUnprofitable": "Route non rentable par problèmes opérationnels",
    "DemandUnprofitable": "Route non rentable par manque de demande",
    "RouteToDefend": "Route rentable sous pression concurrentielle",
    "StableRoute": "Route stable sans signal particulier",
    "HighValueAtRisk": "Client haute valeur à risque de churn",
    "LoyaltyConversionTarget": "Client à convertir au programme fidélité",
    "PremiumUpgradeCandidate": "Client éligible à une offre premium",
    "AncillaryOfferTarget": "Client cible pour les offres ancillaires",
    "ReactivationTarget": "Client inactif à réactiver",
    "StableCustomer": "Client stable sans signal particulier",
}
ROUTE_PROPERTIES = {  # property: (xsd type, metric column)
    "hasLoadFactorPct": ("decimal", "avg_load_factor_pct"),
    "hasMarginPct": ("decimal", "avg_margin_pct"),
    "hasDelayRatePct": ("decimal", "delay_rate_pct"),
    "hasNbCompetitors": ("integer", "nb_competitors"),
    "isStrategicRoute": ("boolean", "is_strategic_route"),
    "hasRouteKey": ("string", "route_key"),
    "hasAvgSentimentScore": ("decimal", "avg_sentiment_score"),
}
CUSTOMER_PROPERTIES = {
    "isHighValue": ("boolean", "is_high_value"),
    "isAtRisk": ("boolean", "is_at_risk"),
    "hasSentimentScore": ("decimal", "avg_sentiment_score"),
    "hasTotalMiles": ("integer", "total_miles"),
    "hasTotalBookings": ("integer", "total_bookings"),
    "hasTotalRevenue": ("decimal", "total_revenue"),
    "hasAncillaryAttachRate": ("decimal", "ancillary_attach_rate"),
    "hasDaysSinceLastFlight": ("integer", "days_since_last_flight"),
    "isLoyaltyMember": ("boolean", "is_loyalty_member"),
    "hasCriticalTickets": ("integer", "critical_tickets"),
    "hasCustomerSegment": ("string", "customer_segment"),
    "hasCustomerKey": ("string", "customer_id"),
}
LINK_PROPERTIES = {  # property: (domain, range)
    "hasOrigin": ("Route", "Airport"),
    "hasDestination": ("Route", "Airport"),
    "hasCompetitor": ("Route", "Airline"),
}
DISJOINT_PAIRS = (
    ("HighValueAtRisk", "StableCustomer"),
    ("GrowthOpportunity", "DemandUnprofitable"),
    ("GrowthOpportunity", "StrategicUnderperformer"),
)
NEVER_FLEW_DAYS = 999  # days since last flight for customers without a booking
INFERENCE_SOURCE = "OWL inference"
RULE_SOURCE = "OWL inference — règles SPARQL CONSTRUCT"
CROSS_SOURCE = "OWL cross-domain inference"
DEFAULT_REASON = "Aucun signal particulier — label par défaut"
CROSS_INSIGHT = (
    "Ces routes sous-performantes affectent probablement la satisfaction des clients à risque."
)
