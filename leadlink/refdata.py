"""Small fixed lookup tables and the DataFrames made from them.

Every table here has a fixed number of rows (170 at most), so broadcasting one is
always safe whatever the size of the data it is joined to.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Activity code labels on three levels (division, class, sub-class).
ACTIVITY_LABELS = """
10 Industrie alimentaire
16 Travail du bois
31 Fabrication de meubles
33 Réparation / installation de machines
36 Captage, traitement, distribution d'eau
41 Construction de bâtiments
43 Travaux de construction spécialisés
45 Commerce / réparation automobile
46 Commerce de gros
47 Commerce de détail
55 Hébergement
56 Restauration
62 Programmation / conseil informatique
68 Activités immobilières
69 Activités juridiques et comptables
71 Architecture et ingénierie
74 Autres activités spécialisées
84 Administration publique
86 Activités pour la santé humaine
87 Hébergement médico-social
88 Action sociale sans hébergement
95 Réparation d'ordinateurs et biens personnels
96 Autres services personnels
10.13 Préparation de produits à base de viande
10.71 Fabrication pain / pâtisserie fraîche
16.23 Fabrication de charpentes et menuiseries
31.01 Fabrication de meubles de bureau
31.02 Fabrication de meubles de cuisine
33.15 Réparation de navires / machines
36.00 Captage, traitement, distribution d'eau
41.20 Construction de bâtiments
43.21 Installation électrique
43.22 Plomberie, chauffage, climatisation
43.29 Autres travaux d'installation
43.31 Travaux de plâtrerie
43.32 Travaux de menuiserie
43.33 Travaux de revêtement des sols
43.34 Peinture et vitrerie
43.99 Autres travaux de construction spécialisés
45.11 Commerce de voitures
45.20 Entretien / réparation automobile
45.31 Commerce de gros d'équipements auto
45.32 Commerce de détail d'équipements auto
45.40 Commerce / réparation de motocycles
46.19 Intermédiaires du commerce en gros
46.72 Commerce de gros métaux / minerais
46.73 Commerce de gros bois / matériaux construction
46.74 Commerce de gros quincaillerie / fournitures
47.11 Commerce de détail alimentaire (non spécialisé)
47.19 Autre commerce de détail non spécialisé
47.21 Commerce de détail fruits et légumes
47.22 Commerce de détail viandes
47.23 Commerce de détail poissons
47.24 Commerce de détail pain / pâtisserie
47.25 Commerce de détail boissons
47.29 Autres commerces alimentaires spécialisés
47.30 Commerce carburants en magasin
47.41 Commerce ordinateurs / logiciels
47.42 Commerce matériel télécom
47.43 Commerce matériel audio / vidéo
47.51 Commerce de détail textiles
47.52 Commerce de détail quincaillerie / peintures
47.53 Commerce de détail tapis / revêtements
47.54 Commerce d'appareils électroménagers
47.59 Commerce meubles / éclairage / autres
47.64 Commerce articles de sport
47.65 Commerce jeux et jouets
47.71 Commerce de détail habillement
47.72 Commerce de détail chaussures
47.73 Commerce pharmacie
47.76 Commerce fleurs / plantes / graines
47.77 Commerce horlogerie / bijouterie
47.79 Commerce de détail d'occasion
55.10 Hôtels et hébergement similaire
56.10 Restaurants et services de restauration
56.21 Services des traiteurs
62.01 Programmation informatique
68.31 Agences immobilières
68.32 Administration de biens immobiliers
69.10 Activités juridiques
69.20 Comptabilité / audit / conseil fiscal
71.12 Activités d'ingénierie
74.90 Autres activités spécialisées n.c.a.
84.11 Administration publique générale
86.10 Activités hospitalières
86.21 Activité des médecins généralistes
86.22 Activité des médecins spécialistes
86.23 Pratique dentaire
86.90 Autres activités pour la santé humaine
87.10 Hébergement médicalisé
87.30 Hébergement social pour personnes âgées / handicapées
88.10 Action sociale sans hébergement pour personnes âgées
88.91 Action sociale sans hébergement pour jeunes enfants
95.25 Réparation horlogerie / bijouterie
96.02 Coiffure et soins de beauté
10.13A Préparation industrielle de viande de boucherie
10.13B Charcuterie
10.71A Fabrication industrielle de pain
10.71B Cuisson de produits de boulangerie
10.71C Boulangerie et boulangerie-pâtisserie
10.71D Pâtisserie
41.20A Construction de maisons individuelles
41.20B Construction d'autres bâtiments
43.21A Travaux d'installation électrique dans tous locaux
43.21B Travaux d'installation électrique sur la voie publique
43.22A Travaux d'installation d'eau et de gaz
43.22B Travaux d'installation d'équipements thermiques
43.29A Travaux d'isolation
43.29B Autres travaux d'installation n.c.a.
43.32B Travaux de menuiserie métallique et serrurerie
43.99B Travaux de montage de structures métalliques
43.99C Travaux de maçonnerie générale et gros œuvre
43.99D Autres travaux spécialisés de construction
45.20A Entretien et réparation de véhicules légers
45.20B Entretien et réparation d'autres véhicules
46.19A Centrales d'achat non alimentaires
46.73A Commerce de gros de bois et matériaux
46.73B Commerce de gros d'appareils sanitaires
46.74A Commerce de gros de quincaillerie
46.74B Commerce de gros de fournitures
47.11B Commerce d'alimentation générale
47.11C Supérettes
47.11D Supermarchés
47.11F Hypermarchés
47.19A Grands magasins
47.19B Autres commerces de détail non spécialisés
47.21Z Commerce de détail fruits et légumes (magasin)
47.22Z Commerce de détail viandes (magasin)
47.23Z Commerce de détail poissons (magasin)
47.24Z Commerce de détail pain / pâtisserie / confiserie
47.25Z Commerce de détail boissons (magasin)
47.29Z Autres commerces alimentaires spécialisés (magasin)
47.52A Commerce de détail quincaillerie
47.52B Commerce de détail bricolage
47.59A Commerce de détail meubles
47.59B Commerce de détail autres équipements du foyer
47.72A Commerce de détail chaussures
56.10A Restauration traditionnelle
56.10B Cafétérias et autres libres-services
56.10C Restauration rapide
56.21Z Services de traiteurs
55.10Z Hôtels et hébergement similaire
62.01Z Programmation informatique
68.31Z Agences immobilières
68.32A Administration d'immeubles
69.10Z Activités juridiques
69.20Z Comptabilité et audit
71.12B Ingénierie et études techniques
74.90A Activité des économistes de la construction
84.11Z Administration publique générale
86.10Z Activités hospitalières
86.21Z Activité des médecins généralistes
86.22A Activités de radiodiagnostic et radiothérapie
86.22B Activités chirurgicales
86.22C Autres activités des médecins spécialistes
86.23Z Pratique dentaire
86.90A Ambulances
86.90B Laboratoires d'analyses médicales
86.90D Activités des infirmiers
86.90E Activités des professionnels de la rééducation
86.90F Activités de santé humaine non classées ailleurs
87.10A Hébergement médicalisé pour personnes âgées
87.10C Hébergement médicalisé pour enfants handicapés
87.30A Hébergement social pour personnes âgées
87.30B Hébergement social pour handicapés mentaux / malades mentaux
88.10A Aide à domicile
88.91A Accueil de jeunes enfants
95.25Z Réparation d'articles d'horlogerie et de bijouterie
96.02A Coiffure
96.02B Soins de beauté
"""

# Activity sub-class -> occupation codes.
ACTIVITY_OCCUPATIONS = """
10.13A D1103
10.13B D1103
10.71A D1102
10.71B D1102
10.71C D1102 D1104
10.71D D1104
56.10A G1602 G1603
56.10B G1603
56.10C G1603
56.21Z G1602
55.10Z G1703 G1501
47.11B D1106
47.11C D1106
47.11D D1504 D1106
47.11F D1504
47.19A D1502
47.19B D1502
47.21Z D1106
47.22Z D1103
47.23Z D1106
47.24Z D1106
47.25Z D1106
47.29Z D1106
45.11Z D1404
45.20A I1604
45.20B I1604
45.31Z G1404 I1604
45.32Z G1404
45.40Z I1607
68.31Z C1504 C1501
68.32A C1502
69.20Z M1203
69.10Z K1903
96.02A D1202
96.02B D1208
47.73Z J1307
47.76Z D1209
95.25Z I1401
47.77Z D1214
46.72Z D1214
46.19A D1502
46.73A D1212
46.73B D1212
46.74A D1212
46.74B D1212
43.21A F1602
43.21B F1602
43.22A F1603
43.22B F1603
43.29A F1601
43.29B F1601
43.31Z F1611
43.32B F1607
43.33Z F1603
43.34Z F1606
43.99B F1611
43.99C F1606
43.99D F1612
41.20A F1201
41.20B F1201
74.90A F1106
71.12B F1106
33.15Z I1604
36.00Z F1603
16.23Z F1607
31.01Z H2206
31.02Z H2206
62.01Z M1805 M1802
86.10Z J1306 J1501 J1502 J1506 J1507
86.21Z J1102
86.22A J1103
86.22B J1104
86.22C J1102 J1104
86.23Z J1303
86.90A J1502
86.90B J1404
86.90D J1411
86.90E J1404 J1409
86.90F J1403
87.10A J1501 J1506 K1301 K1302
87.10C J1501 K1301
87.30A K1302 K1207
87.30B K1207 K1301
88.10A K1302 K1304
88.91A K1303 G1202
84.11Z K1404 K1602
47.30Z G1502
47.41Z D1211
47.42Z D1211
47.43Z D1211
47.51Z D1212
47.52A D1212
47.52B D1212
47.53Z D1212
47.54Z D1212
47.59A D1212
47.59B D1212
47.64Z D1212
47.65Z D1212
47.71Z D1212
47.72A D1212
47.79Z D1212
"""

# Sector profile, its label, its activity codes.
PROFILES = """
sb_etablissement_de_sante | Établissement de santé | 86.10 86.21 86.22 86.23 86.90B
sb_accueil_enfants | Accueil enfants | 88.91A 84.11Z
sb_fleuriste | Fleuriste | 47.76
sb_service_a_la_personne | Service à la personne | 87.10A 87.10C 87.30 88.10A
sb_coiffure | Coiffure | 96.02
sb_esthetique | Esthétique | 96.02A 96.02B
btpm_batiment | Bâtiment | 41.20A 41.20B 43.32B 43.33Z 43.99B 43.99C 71.12B 74.90A 84.11Z
btpm_electricite | Électricité | 33.15Z 36.00Z 41.20A 43.21A 43.21B 43.22B 43.29B 43.31Z 43.99C 45.11Z 84.11Z
btpm_plomberie | Plomberie | 36.00Z 41.20B 43.21A 43.22 43.34Z
btpm_chauffage_clim | Chauffage / Clim | 43.22A 43.22B
btpm_menuiserie | Menuiserie | 16.23Z 31.01Z 31.02Z 41.20A 43.29A 43.32B 43.99D 84.11Z
btpm_meca_carrosserie | Méca / Carrosserie | 45.11Z 45.20 45.31Z 45.32 84.11Z
btpm_moto | Moto | 45.40Z
tg_stations_services | Stations services | 47.3 47.30
tg_magasins_informatique_high_tech | Informatique / High tech | 47.4 47.41 47.42 47.43 47.54
tg_magasins_vetements_chaussures | Vêtements / Chaussures | 47.5 47.51 47.52 47.53 47.54 47.59 47.71 47.72
tg_magasins_de_sport | Sport | 47.64 47.65
tg_magasins_occasions | Occasions | 47.79
tg_bijoutiers | Bijoutiers | 46.72 47.77 95.25
tg_maison_deco_ameublement_bricolage | Maison / Déco / Ameublement / Bricolage | 46.19A 46.73 46.74 47.52 47.53 47.59
tg_agences_immobilieres | Agences immobilières | 68.31
mbt_boulangeries | Boulangeries | 10.71
mbt_grande_distribution | Grande distribution | 47.11
mbt_commerce_de_bouche | Commerce de bouche | 47.21 47.22 47.23 47.24 47.25 47.29
mbt_restaurants | Restaurants | 56.10A
"""

# Former profile name -> present profile name.
PROFILE_ALIASES = """
sb_sante sb_etablissement_de_sante
sb_service_personne sb_service_a_la_personne
tg_informatique tg_magasins_informatique_high_tech
tg_vetements_chaussures tg_magasins_vetements_chaussures
tg_sport tg_magasins_de_sport
tg_occasions tg_magasins_occasions
tg_stations_service tg_stations_services
tg_immobilier tg_agences_immobilieres
"""

# Profile name prefix -> sector, and the order sectors are shown in.
SECTOR_PREFIXES = "sb SB, btpm BTPM, mbt MBT, tg TG"
SECTOR_DISPLAY_ORDER = ["SB", "BTPM", "MBT", "TG"]

# City -> latitude, longitude.
GAZETTEER = """
paris | 48.8566 | 2.3522
lyon | 45.7640 | 4.8357
marseille | 43.2965 | 5.3698
toulouse | 43.6047 | 1.4442
bordeaux | 44.8378 | -0.5792
lille | 50.6292 | 3.0573
nice | 43.7102 | 7.2620
nantes | 47.2184 | -1.5536
strasbourg | 48.5734 | 7.7521
montpellier | 43.6108 | 3.8767
rennes | 48.1173 | -1.6778
toulon | 43.1242 | 5.9280
grenoble | 45.1885 | 5.7245
dijon | 47.3220 | 5.0415
angers | 47.4784 | -0.5632
reims | 49.2583 | 4.0317
le mans | 48.0061 | 0.1996
aix-en-provence | 43.5297 | 5.4474
clermont-ferrand | 45.7772 | 3.0870
tours | 47.3941 | 0.6848
boulogne-billancourt | 48.8397 | 2.2399
paris 20 | 48.8637 | 2.3985
paris 20e | 48.8637 | 2.3985
"""

# Chain-store keywords, tested in this order as substrings.
BRAND_KEYWORDS = """
lidl, aldi, auchan, monoprix, picard, picard surgeles, picard surgelés,
carrefour hypermarche, carrefour hypermarché, mcdonald, mcdonalds, mcdonald's,
burger king, kfc, subway, domino's, dominos, pizza hut, quick, o'tacos, otacos,
chamas tacos, nabab kebab, nabab, esso, apple store, zara, h&m, uniqlo, kiabi,
celio, primark, decathlon, cartier, van cleef, pandora, swarovski, ikea,
maisons du monde, leroy merlin, castorama, brico depot, brico dépôt, foncia, paul
"""
# Fixed value: keyword tested as a whole word, after all of the above.
BRAND_WHOLE_WORD = "kebab"

# Excluded listing categories and their keywords, in order.
CATEGORY_KEYWORDS = """
Pharmacies | pharmacie, pharmacien, parapharmacie
Centres d'hébergement | centre d'hebergement, centre d hebergement, hebergement d'urgence, chrs, cada, huda, centre d'accueil
Foyers jeunes | foyer de jeunes, foyer jeunes travailleurs, fjt, foyer pour jeunes, foyer d'accueil
Centres de planification | centre de planification, planification familiale, cpef, planning familial
"""

# Sectors a user can tick, their activity codes and search keyword.
SECTOR_CATALOGUE = """
Boulangerie / Pâtisserie | 10.71C 10.71D | boulangerie pâtisserie
Boulangerie industrielle | 10.71A 10.71B | boulangerie
Pâtisserie | 10.71D | pâtisserie
Boucherie / Charcuterie | 10.13A 10.13B 47.22Z | boucherie charcuterie
Restauration traditionnelle | 56.10A | restaurant
Restauration rapide | 56.10B 56.10C | restauration rapide
Traiteur | 56.21Z | traiteur
Hôtellerie | 55.10Z | hôtel
Supermarché / Hypermarché | 47.11D 47.11F | supermarché
Commerce alimentaire de proximité | 47.11B 47.11C | épicerie
Garage automobile | 45.20A 45.20B | garage automobile
Concession automobile | 45.11Z | concessionnaire automobile
Agence immobilière | 68.31Z | agence immobilière
Cabinet comptable | 69.20Z | expert comptable
Cabinet d'avocat | 69.10Z | avocat
Coiffure | 96.02A | coiffeur
Esthétique / Soins de beauté | 96.02B | institut de beauté
Pharmacie | 47.73Z | pharmacie
Fleuriste | 47.76Z | fleuriste
Électricité (BTP) | 43.21A | électricien
Plomberie / Chauffage | 43.22A 43.22B | plombier chauffagiste
Peinture (BTP) | 43.34Z | peintre bâtiment
Menuiserie | 43.32A | menuisier
"""

# City, its commune codes; owners are placeholders set by the user.
REGISTRY_CITIES = """
Lyon | 69381 69382 69383 69384 69385 69386 69387 69388 69389
Drancy | 93029
Le Blanc-Mesnil | 93007
Pantin | 93055
Bobigny | 93008
Saint-Ouen-sur-Seine | 93070
Montpellier | 34172
Boulogne-Billancourt | 92012
Nanterre | 92050
Rueil-Malmaison | 92063
Lille | 59350
"""
REGISTRY_ACTIVITIES = ["10.71C", "10.71D", "47.24Z"]

# Output column names of the leads file, in order.
LEAD_DISPLAY = {
    "name": "Nom de l'entreprise",
    "siret": "SIRET",
    "naf": "Code NAF",
    "address": "Adresse",
    "city": "Ville",
    "cp": "Code Postal",
    "phone": "Téléphone",
    "phone_source": "Source téléphone",
    "website": "Site web",
    "priority": "Priorité",
    "source": "Source",
    "lbb_score": "Score LBB",
    "offers": "Offres actives",
    "collected_on": "Date de collecte",
}

# Output column names of the other stages, in order.
LISTING_DISPLAY = {
    "name": "Nom de l'entreprise",
    "address": "Adresse",
    "city": "Ville",
    "cp": "Code Postal",
    "search_city": "Ville de recherche",
    "phone": "Téléphone",
    "website": "Site web",
    "category": "Catégorie",
    "listing_url": "URL fiche PJ",
    "collected_on": "Date de collecte",
}
ENRICHED_DISPLAY = {
    **LISTING_DISPLAY,
    "siret": "SIRET",
    "naf": "Code NAF",
    "status": "Statut enrichissement",
    "score": "Score similarité",
}
PROFILED_DISPLAY = {
    "name": "Nom de l'entreprise",
    "address": "Adresse",
    "city": "Ville",
    "cp": "Code Postal",
    "search_city": "Ville de recherche",
    "phone": "Téléphone",
    "website": "Site web",
    "category": "Catégorie",
    "collected_on": "Date de collecte",
    "siret": "SIRET",
    "siren": "SIREN",
    "naf": "Code NAF",
    "headcount": "Effectifs",
    "director": "Dirigeant",
    "revenue": "Chiffre d'affaires",
    "created_on": "Date de création",
    "legal_form": "Forme juridique",
    "status": "Statut enrichissement",
    "score": "Score similarité",
    "enriched_by": "Source enrichissement",
}
SIGNAL_DISPLAY = {
    "name": "Nom de l'entreprise",
    "siret": "SIRET",
    "naf": "Code NAF",
    "address": "Adresse",
    "city": "Ville",
    "cp": "Code Postal",
    "phone": "Téléphone",
    "search_city": "Ville de recherche",
    "source": "Source",
    "lbb_score": "Score LBB",
    "offers": "Offres actives",
    "collected_on": "Date de collecte",
}
SECTOR_DISPLAY = {
    "training": "Formation associée",
    "kind": "Type d'établissement",
    "name": "Nom entreprise",
    "full_address": "Adresse complète",
    "cp": "Code postal",
    "city": "Ville",
    "dept": "Département",
    "phone": "Téléphone",
    "siret": "SIRET",
    "website": "Site web",
    "source": "Source",
    "collected_on": "Date de collecte",
}
REGISTRY_DISPLAY = {
    "name": "Nom établissement",
    "address": "Adresse",
    "phone": "Numéro de téléphone",
    "kind": "Type d'établissement",
    "priority": "Priorité",
    "owner": "Propriétaire",
    "siren": "SIREN",
}


def _lines(block: str) -> list[list[str]]:
    return [[f.strip() for f in ln.split("|")] for ln in block.strip().splitlines()]


def label_rows() -> list[tuple[str, str]]:
    return [tuple(ln.split(" ", 1)) for ln in ACTIVITY_LABELS.strip().splitlines()]


def occupation_rows() -> list[tuple[str, list[str]]]:
    return [(c, r.split()) for c, r in (ln.split(" ", 1) for ln in ACTIVITY_OCCUPATIONS.strip().splitlines())]


def profile_rows() -> list[tuple[str, str, list[str]]]:
    return [(p, lab, codes.split()) for p, lab, codes in _lines(PROFILES)]


def alias_rows() -> list[tuple[str, str]]:
    return [tuple(ln.split()) for ln in PROFILE_ALIASES.strip().splitlines()]


def sector_prefix_rows() -> list[tuple[str, str]]:
    return [tuple(p.split()) for p in SECTOR_PREFIXES.split(",")]


def gazetteer_rows() -> list[tuple[str, float, float]]:
    return [(c, float(la), float(lo)) for c, la, lo in _lines(GAZETTEER)]


def brand_keywords() -> list[str]:
    return [k.strip() for k in BRAND_KEYWORDS.replace("\n", " ").split(",")]


def category_rows() -> list[tuple[int, str, str]]:
    pairs = [(cat, k.strip()) for cat, kws in _lines(CATEGORY_KEYWORDS) for k in kws.split(",")]
    return [(i, cat, kw) for i, (cat, kw) in enumerate(pairs)]


def catalogue_rows() -> list[tuple[int, str, list[str], str]]:
    return [(i, lab, codes.split(), kw) for i, (lab, codes, kw) in enumerate(_lines(SECTOR_CATALOGUE))]


def registry_city_rows() -> list[tuple[str, list[str], str]]:
    return [(c, codes.split(), f"owner {i + 1}") for i, (c, codes) in enumerate(_lines(REGISTRY_CITIES))]


def small_frame(spark: SparkSession, rows: list[tuple], names: list[str], types: list[pa.DataType]) -> DataFrame:
    """A fixed table as a local relation (known size, no job to build it)."""
    cols = list(zip(*rows)) if rows else [[] for _ in names]
    return spark.createDataFrame(pa.table({n: pa.array(list(c), t) for n, c, t in zip(names, cols, types)}))


S, L = pa.string(), pa.list_(pa.string())


def labels(spark: SparkSession) -> DataFrame:
    return small_frame(spark, label_rows(), ["code", "label"], [S, S])


def occupations(spark: SparkSession) -> DataFrame:
    return small_frame(spark, occupation_rows(), ["naf", "romes"], [S, L])


def profiles(spark: SparkSession) -> DataFrame:
    return small_frame(spark, profile_rows(), ["profile", "label", "nafs"], [S, S, L])


def aliases(spark: SparkSession) -> DataFrame:
    return small_frame(spark, alias_rows(), ["alias", "profile"], [S, S])


def sector_prefixes(spark: SparkSession) -> DataFrame:
    return small_frame(spark, sector_prefix_rows(), ["prefix", "sector"], [S, S])


def gazetteer(spark: SparkSession) -> DataFrame:
    return small_frame(spark, gazetteer_rows(), ["city_key", "lat", "lon"], [S, pa.float64(), pa.float64()])


def catalogue(spark: SparkSession) -> DataFrame:
    return small_frame(spark, catalogue_rows(), ["pos", "label", "nafs", "keyword"], [pa.int32(), S, L, S])


def categories(spark: SparkSession) -> DataFrame:
    return small_frame(spark, category_rows(), ["pos", "category", "keyword"], [pa.int32(), S, S])


def registry_cities(spark: SparkSession) -> DataFrame:
    return small_frame(spark, registry_city_rows(), ["city", "communes", "owner"], [S, L, S])
