"""Regions with their continent, and countries with their ISO 3166 codes and region."""

from __future__ import annotations

#: Regions, the first for countries that no region is known of, with their continent.
REGIONS = [
    ("Undefined", None), ("North America", "Americas"), ("Central America", "Americas"), ("Antilles", "Americas"), ("South America", "Americas"),
    ("Western Europe", "Europe"), ("Eastern Europe", "Europe"), ("Caucasus", "Europe"), ("Siberia", "Europe"), ("Central Asia", "Asia"), ("East Asia", "Asia"),
    ("North Africa", "Africa"), ("Sub-Saharan Africa", "Africa"), ("Middle East", "Asia"), ("Indian subcontinent", "Asia"), ("Mainland Southeast Asia", "Asia"),
    ("Malay Archipelago", "Asia"), ("Pacific Islands (Melanesia, Micronesia and Polynesia)", "Oceania"), ("Australia", "Oceania"), ("Antarctica", "Antarctica"),
]

#: ISO 3166 codes and region by English name. Other countries have no code and the region Undefined.
COUNTRIES = [
    ("Canada", "CA", "CAN", "North America"), ("United States", "US", "USA", "North America"), ("Mexico", "MX", "MEX", "North America"),
    ("Belize", "BZ", "BLZ", "Central America"), ("El Salvador", "SV", "SLV", "Central America"), ("Guatemala", "GT", "GTM", "Central America"), ("Honduras", "HN", "HND", "Central America"),
    ("Nicaragua", "NI", "NIC", "Central America"), ("Costa Rica", "CR", "CRI", "Central America"), ("Panama", "PA", "PAN", "Central America"),
    ("Haiti", "HT", "HTI", "Antilles"), ("Dominican Republic", "DO", "DOM", "Antilles"), ("Cuba", "CU", "CUB", "Antilles"), ("Jamaica", "JM", "JAM", "Antilles"),
    ("Brazil", "BR", "BRA", "South America"), ("Colombia", "CO", "COL", "South America"), ("Argentina", "AR", "ARG", "South America"), ("Peru", "PE", "PER", "South America"),
    ("Chile", "CL", "CHL", "South America"), ("Venezuela", "VE", "VEN", "South America"), ("Ecuador", "EC", "ECU", "South America"), ("Bolivia", "BO", "BOL", "South America"),
    ("Paraguay", "PY", "PRY", "South America"), ("Uruguay", "UY", "URY", "South America"), ("Guyana", "GY", "GUY", "South America"), ("Suriname", "SR", "SUR", "South America"),
    ("Germany", "DE", "DEU", "Western Europe"), ("France", "FR", "FRA", "Western Europe"), ("United Kingdom", "GB", "GBR", "Western Europe"), ("Spain", "ES", "ESP", "Western Europe"),
    ("Italy", "IT", "ITA", "Western Europe"), ("Poland", "PL", "POL", "Eastern Europe"), ("Netherlands", "NL", "NLD", "Western Europe"), ("Belgium", "BE", "BEL", "Western Europe"),
    ("Austria", "AT", "AUT", "Western Europe"), ("Switzerland", "CH", "CHE", "Western Europe"), ("Portugal", "PT", "PRT", "Western Europe"), ("Czech Republic", "CZ", "CZE", "Eastern Europe"),
    ("Hungary", "HU", "HUN", "Eastern Europe"), ("Romania", "RO", "ROU", "Eastern Europe"), ("Sweden", "SE", "SWE", "Western Europe"), ("Norway", "NO", "NOR", "Western Europe"),
    ("Denmark", "DK", "DNK", "Western Europe"), ("Finland", "FI", "FIN", "Western Europe"), ("Greece", "GR", "GRC", "Western Europe"), ("Ireland", "IE", "IRL", "Western Europe"),
    ("Russia", "RU", "RUS", "Siberia"),
    ("Japan", "JP", "JPN", "East Asia"), ("China", "CN", "CHN", "East Asia"), ("India", "IN", "IND", "Indian subcontinent"), ("Indonesia", "ID", "IDN", "Malay Archipelago"),
    ("South Korea", "KR", "KOR", "East Asia"), ("Thailand", "TH", "THA", "Mainland Southeast Asia"), ("Vietnam", "VN", "VNM", "Mainland Southeast Asia"), ("Malaysia", "MY", "MYS", "Malay Archipelago"),
    ("Philippines", "PH", "PHL", "Malay Archipelago"), ("Singapore", "SG", "SGP", "Malay Archipelago"), ("Bangladesh", "BD", "BGD", "Indian subcontinent"), ("Pakistan", "PK", "PAK", "Indian subcontinent"),
    ("Iran", "IR", "IRN", "Middle East"), ("Iraq", "IQ", "IRQ", "Middle East"), ("Jordan", "JO", "JOR", "Middle East"), ("Saudi Arabia", "SA", "SAU", "Middle East"),
    ("Australia", "AU", "AUS", "Australia"), ("New Zealand", "NZ", "NZL", "Pacific Islands (Melanesia, Micronesia and Polynesia)"),
    ("South Africa", "ZA", "ZAF", "Sub-Saharan Africa"), ("Egypt", "EG", "EGY", "North Africa"), ("Nigeria", "NG", "NGA", "Sub-Saharan Africa"), ("Kenya", "KE", "KEN", "Sub-Saharan Africa"),
    ("Morocco", "MA", "MAR", "North Africa"), ("Tanzania", "TZ", "TZA", "Sub-Saharan Africa"), ("Ethiopia", "ET", "ETH", "Sub-Saharan Africa"), ("Algeria", "DZ", "DZA", "North Africa"),
]
