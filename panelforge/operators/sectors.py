"""Industry -> sector hierarchy."""

from __future__ import annotations

# Industries grouped into the eleven sectors used by the
# per-sector series. Industries that are not listed keep their own name.
SECTORS: dict[str, list[str]] = {
    "Basic Materials": ["Agriculture", "Building Materials", "Chemicals", "Coal", "Forest Products",
                        "Metals & Mining", "Steel"],
    "Consumer Cyclical": ["Advertising & Marketing Services", "Autos", "Entertainment",
                          "Homebuilding & Construction", "Manufacturing - Apparel & Furniture",
                          "Packaging & Containers", "Personal Services", "Publishing", "Restaurants",
                          "Retail - Apparel & Specialty", "Travel & Leisure"],
    "Financial Services": ["Asset Management", "Banks", "Brokers & Exchanges", "Credit Services", "Insurance",
                           "Insurance - Life", "Insurance - Property & Casualty", "Insurance - Specialty"],
    "Real Estate": ["Real Estate Services", "REITs"],
    "Consumer Defensive": ["Beverages - Alcoholic", "Beverages - Non-Alcoholic", "Consumer Packaged Goods",
                           "Education", "Retail - Defensive", "Tobacco Products"],
    "Healthcare": ["Biotechnology", "Drug Manufacturers", "Health Care Plans", "Health Care Providers",
                   "Medical Devices", "Medical Diagnostics & Research", "Medical Distribution",
                   "Medical Instruments & Equipment"],
    "Utilities": ["Utilities - Independent Power Producers", "Utilities - Regulated"],
    "Energy": ["Oil & Gas - Drilling", "Oil & Gas - E&P", "Oil & Gas - Integrated", "Oil & Gas - Midstream",
               "Oil & Gas - Refining & Marketing", "Oil & Gas - Services"],
    "Industrials": ["Aerospace & Defense", "Airlines", "Business Services", "Conglomerates", "Consulting & Outsourcing",
                    "Employment Services", "Engineering & Construction", "Farm & Construction Machinery",
                    "Industrial Distribution", "Industrial Products", "Transportation & Logistics",
                    "Truck Manufacturing", "Waste Management"],
    "Technology": ["Application Software", "Communication Equipment", "Computer Hardware", "Online Media",
                   "Semiconductors"],
}


def sector_pairs() -> list[tuple[str, str]]:
    """(industry, sector) rows of the fixed hierarchy."""
    return [(i, s) for s, inds in SECTORS.items() for i in inds]


def sector_values_sql() -> str:
    """The hierarchy as an SQL VALUES list (for the DuckDB twin)."""
    esc = lambda x: x.replace("'", "''")
    return ", ".join(f"('{esc(i)}', '{esc(s)}')" for i, s in sector_pairs())
