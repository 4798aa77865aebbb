"""Fixed values.

Everything here is a constant that results depend on: code lists, word lists,
weights, labels and message texts. They are defaults; each operator takes its
own argument for them.
"""

# Topic prefixes that make a project relevant outright.
TOPIC_PREFIXES = ("HORIZON-CL5-", "HORIZON-CL6-")

# Whole-word alternatives looked for in the objective, case-insensitively.
CLIMATE_TERMS = (
    "climate change",
    "zero emission",
    "net[- ]zero",
    "carbon[- ]neutral",
    "decarboni[sz]ation",
    "greenhouse",
    "CO2",
    "GHG",
    "carbon neutrality",
    "carbon capture",
    "carbon sink",
    "carbon sequestration",
    "zero[- ]carbon",
    "low[- ]carbon",
    "climate mitigation",
    "climate adaptation",
    "climate-neutral",
    "renewable energy",
    "clean energy",
    "green hydrogen",
    "sustainable energy",
    "climate-smart",
    "climate crisis",
    "climate risk",
    "sea level rise",
    "extreme weather",
    "biodiversity loss",
    "circular economy",
    "geoengineering",
    "green technology",
    "global warming",
    "environmental impact",
    "environmental sustainability",
    "energy transition",
)
CLIMATE_PATTERN = r"\b(" + "|".join(CLIMATE_TERMS) + r")\b"

# A phrase is kept when it contains one of these.
PHRASE_STEMS = (
    "climate",
    "carbon",
    "emission",
    "neutral",
    "warming",
    "co2",
    "sustainab",
    "net zero",
    "decarbon",
    "biodiversity",
    "resilience",
)

# Columns left out after organisations and projects are joined.
MERGE_DROP = (
    "projectAcronym",
    "street",
    "postCode",
    "city",
    "nutsCode",
    "geolocation",
    "organizationURL",
    "contactForm",
    "rcn_x",
    "order",
    "active",
    "id",
    "acronym",
    "legalBasis",
    "ecSignatureDate",
    "frameworkProgramme",
    "masterCall",
    "nature",
    "rcn_y",
    "grantDoi",
    "subCall",
    "shortName",
    "vatNumber",
)

# Names after the join; _x is the organisation's column, _y the project's.
MERGE_RENAME = {
    "SME": "organisationSME",
    "activityType": "organisationActivityType",
    "contentUpdateDate_x": "organisationContentUpdateDate",
    "role": "organisationRole",
    "totalCost_x": "organisationTotalCost",
    "endOfParticipation": "organisationEndOfParticipation",
    "totalCost_y": "projectTotalCost",
    "contentUpdateDate_y": "projectContentUpdateDate",
    "title": "projectTitle",
    "name": "organisationName",
}

# Columns holding European-format money text in the merged table.
MONEY_COLUMNS = (
    "ecContribution",
    "netEcContribution",
    "organisationTotalCost",
    "projectTotalCost",
    "ecMaxContribution",
)

# Member states scored, by ISO 3166 alpha-2 code (Greece is GR).
EU_MEMBERS = (
    "AT", "BE", "BG", "HR", "CY", "CZ", "DK", "EE", "FI", "FR", "DE", "GR", "HU", "IE",
    "IT", "LV", "LT", "LU", "MT", "NL", "PL", "PT", "RO", "SK", "SI", "ES", "SE",
)

# Display names by code (Greece is EL here).
COUNTRY_NAMES = {
    "AT": "Austria", "BE": "Belgium", "BG": "Bulgaria", "CY": "Cyprus", "CZ": "Czech Republic",
    "DE": "Germany", "DK": "Denmark", "EE": "Estonia", "EL": "Greece", "ES": "Spain",
    "FI": "Finland", "FR": "France", "HR": "Croatia", "HU": "Hungary", "IE": "Ireland",
    "IT": "Italy", "LT": "Lithuania", "LU": "Luxembourg", "LV": "Latvia", "MT": "Malta",
    "NL": "Netherlands", "PL": "Poland", "PT": "Portugal", "RO": "Romania", "SE": "Sweden",
    "SI": "Slovenia", "SK": "Slovakia",
}

# Metrics that are scaled and scored, and their weights.
METRICS = (
    "funding_share",
    "ec_per_gdp",
    "project_share",
    "org_share",
    "collab_project_ratio",
    "success_ratio",
)
SCORE_WEIGHTS = {
    "funding_share_scaled": 0.20,
    "ec_per_gdp_scaled": 0.20,
    "project_share_scaled": 0.15,
    "org_share_scaled": 0.15,
    "collab_project_ratio_scaled": 0.15,
    "success_ratio_scaled": 0.15,
}

AVERAGE_LABEL = "EU Average"

# Scenario parameters: country -> peer, year -> shock.
PROJECTION_PEERS = {"MT": "CY", "HR": "ES"}
PROJECTION_SHOCKS = {
    2030: "Funding reduction",
    2036: "Policy withdrawal",
    2043: "Technological disruption",
}

# Text of the scenario explanation; {rate} is the stated adoption rate in percent.
EXPLANATION = (
    "{country} is compared to {peer}, a country with a comparable economic footprint "
    "(GDP) but stronger EU participation metrics. The simulation projects how {country}'s performance "
    "would evolve if it progressively adopted {rate}% of {peer}'s participation metrics across collaboration, "
    "project density, and funding absorption. Global events like the {shocks} "
    "are modeled to induce plausible setbacks. This scenario helps gauge feasibility and impact toward 2050 EU cohesion goals."
)
STATED_RATE = 85

# Prepared summaries by country; any other country has an empty one.
SUMMARIES = {
    "MT": (
        "Malta's current climate engagement, measured through a composite performance score, reflects low levels of "
        "collaboration, project density, and EU funding absorption. Cyprus, though similarly sized in GDP, performs "
        "significantly better on these metrics. This projection simulates Malta’s trajectory if it progressively adopted "
        "95% of Cyprus’s participation profile. Despite global setbacks like recessions or policy shifts, the improved "
        "path shows a clear and sustained rise in performance. This comparison highlights the untapped potential for "
        "smaller member states to scale their climate role by learning from structurally similar but more active peers."
    ),
    "HR": (
        "Croatia's climate project engagement lags behind that of Spain — one of the EU’s top performers — despite both "
        "facing comparable challenges in implementation scale. The current performance score reflects Croatia’s lower funding "
        "uptake and collaboration rates. If Croatia were to align with 95% of Spain’s project participation metrics, the "
        "simulation shows nearly a twofold improvement by 2050. This projection offers an aspirational benchmark, letting "
        "policymakers compare outcomes from aligning with the EU’s best-in-class performers versus structurally similar ones. "
        "It helps prioritize whether to close the gap with leaders or focus on achievable stepwise targets."
    ),
}

# Texts that a CSV reader with the usual missing-value rules takes as missing.
MISSING_MARKERS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
