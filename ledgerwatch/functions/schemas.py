"""Schemas of the register tables, as DDL."""

from __future__ import annotations

REP_INFO = "representants_id bigint, denomination string, identifiant_national string, ville string, date_premiere_publication string, dateCessation string"
EXERCISE = "exercices_id bigint, representants_id bigint, annee_fin int, nombre_activites int, nombre_salaries double, montant_depense_inf bigint, montant_depense_sup bigint"
ACTIVITY = "exercices_id bigint, objet_activite string, date_publication_activite string"
CLIENT_REL = "representants_id bigint, identifiant_national_client string, dateAjout string, dateCessation string, ancienClient boolean"
COLLABORATOR = "representants_id bigint, nom_collaborateur string, prenom_collaborateur string"
PROVIDERS = "array<struct<name:string,amount:bigint>>"
FILING = f"org_name_pdf string, montant_employes bigint, nb_personnels int, cabinets {PROVIDERS}, nb_cabinets int, total_cabinets bigint, montant_avantages bigint, total_declare bigint, source_file string, source_year int, dossier_id string, folder_org_name string"
ENTITY = "register_id string, name string, category string, section string, type string, register_url string, budget_low bigint, budget_high bigint, people_involved int, nb_intermediaries int"
EP_ROW = "title string, member_id string, member_name string, meeting_date date, member_capacity string, procedure_reference string, attendees string, lobbyist_id string"
EC_ROW = "date date, Org string, OrgId string, subject string, cabinet string, Host array<string>"
BUDGET_MAP = "map<string,struct<name:string,budget_by_year:map<string,double>>>"
REGISTRANT = "id string, name string, registrationDate date, objectives string"
ACCREDITED = "register_id string, surname string, first_name string, start_date date"
WORD = "file string, page int, ord int, text string, x0 double, x1 double, top double"

#: File names of the export's tables.
REGISTER_FILES = {"rep_info": ("1_informations_generales.csv", REP_INFO), "exercise": ("15_exercices.csv", EXERCISE), "activity": ("8_objets_activites.csv", ACTIVITY), "client_rel": ("4_clients.csv", CLIENT_REL), "collaborator": ("3_collaborateurs.csv", COLLABORATOR)}
