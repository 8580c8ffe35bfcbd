"""Labelled texts made by rule, for fitting and checking the span classifier.

Every text is put together from patterns: [a|b] is one of the alternatives, {x} a slot. The patterns speak of offices,
clinics, schools, shops, rentals, courts, logs and forms; they were written for this purpose and stand in no corpus."""

from __future__ import annotations

import random
import re
import unicodedata
from collections.abc import Iterator

from .pii_words import BREAK, GIVEN

_GIVEN = sorted(GIVEN)
_ON, _MID, _END = "b br d dr f fl g gn j k kr l m n p ph qu r s st t tr v vr w y z ch sh".split(), "a e i o u é ou an on è ai ei".split(), "lou ra mé vi ka no ssi do ba ré go li ta pé zon gné ner son ez ic ang wei ko".split()
_FIRMS = ["SA", "SARL", "International", "Industries", "Services", "Négoce", "et Cie", "Réunis", "Réunis SA", "Holding", "Ltd", "Group", "Groupe", "GmbH", "Inc", "Transports", "Consulting", "Partners", "Bank", "& Fils", "Assurances"]
_FR_STREET = "rue R. bd avenue boulevard quai allée chemin place impasse route passage".split()
_EN_STREET = "Street Road Lane Avenue Drive Close Court".split()
_NOUNS = "Forgerons Manguiers Tisserands Palmiers Pêcheurs Lavoirs Tambours Jardins Potiers Écoles Marchés Rôniers Bateliers Hérons Puits Moulins Acacias Tilleuls".split()
_EN_NOUNS = ["Weaver", "Copper", "Quiet Bridge", "Heron", "Station", "Palm", "Harbour", "Orchard Yard", "King", "Chestnut", "North Gate", "Mill Pond", "Elm", "Saint Mark"]
_FR_THINGS = (
    "rapport projet contrat réunion comité service bureau plan budget conseil centre programme règlement syndicat atelier marché registre tableau livret cahier tribunal collège dispensaire gare port "
    "chantier musée stock magasin barème quartier calendrier formulaire guichet hangar camion moteur filtre capteur compteur semestre trimestre bilan audit inventaire"
).split()
_FR_HOW = "général principal annuel régional social technique public national central financier scolaire médical juridique interne commercial municipal provisoire spécial local mensuel sanitaire agricole industriel".split()
_EN_THINGS = (
    "report project contract meeting committee office plan budget council centre program market register table court college station harbour yard museum store schedule form desk engine filter sensor quarter "
    "audit inventory policy review survey board unit team branch service system release summary index"
).split()
_EN_HOW = "general main annual regional social technical public national central financial legal internal commercial local monthly special open final joint senior medical upper early green field".split()
#: Frequent words of either language, for headings and as knowledge of what is no name.
_FR_FREQUENT = (
    "temps homme femme jour monde pays ville maison travail eau vie droit état loi terre école enfant famille santé argent prix vente achat client produit qualité résultat ressource humain personnel équipe chef "
    "marque réseau système sécurité service énergie climat transport route mer fleuve forêt village région nation peuple histoire culture langue livre presse radio image musique sport jeu fête semaine année heure "
    "matin soir hiver été printemps automne nord sud grand petit nouveau vieux premier dernier haut bas bon mauvais libre ouvert fermé blanc noir rouge vert bleu orange jaune gros court long fort rapide lent simple "
    "annuelle générale principale nationale régionale sociale publique centrale financière scolaire médicale juridique commerciale municipale spéciale locale ressources humaines affaires étrangères résultats comptes cours"
).split()
_EN_FREQUENT = (
    "time year people way day man woman child world life hand part place case week company system program question work government number night point home water room mother area money story fact month lot right study "
    "book eye job word business issue side kind head house service friend father power hour game line end member law car city community name president team minute idea body information back parent face others level "
    "health art war history party result change morning reason research girl guy moment air teacher force education quarterly results market outlook resources human new old great high big small large national young "
    "different black white red blue green orange long little important public bad same able full early best better free real sure whole clear recent low late hard major economic strong possible private wrong"
).split()
_VERBS = "ferme ouvre change dépasse retarde bloque suit remplace précède contient vérifie prépare annule couvre résume".split()
_EN_VERBS = "closes opens changes exceeds delays blocks follows replaces precedes holds checks prepares cancels covers splits".split()


class _Maker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def pick(self, xs):
        return self.r.choice(xs)

    def stem(self, n: int | None = None) -> str:
        return "".join(self.pick(_ON) + self.pick(_MID) for _ in range(n or self.r.randint(1, 2))) + self.pick(_END)

    def town(self) -> str:
        return self.pick(["", "", "", "", "Port-", "Grand-", "Saint-", "San ", "New ", "Port ", f"{self.stem(1).capitalize()} "]) + self.stem().capitalize()

    def firm(self) -> str:
        s = self.stem().capitalize()
        return f"{s} {self.pick(_FIRMS)}" if self.r.random() < 0.85 else f"{self.pick(['Banque', 'Hôtel', 'Clinique', 'Société', 'Groupe', 'Transports', 'Assurances', 'Institut'])} {s}"

    def heading(self) -> str:
        """Capitalised words that are no name."""
        r = self.r.random()
        if r < 0.45:
            ws = [self.pick(_FR_THINGS), self.pick(_FR_HOW)] if self.r.random() < 0.6 else [self.pick(_FR_FREQUENT), self.pick(_FR_FREQUENT)]
            ws = ws if self.r.random() < 0.7 else [*ws, self.pick(_FR_HOW)]
        elif r < 0.8:
            ws = [self.pick(_EN_HOW), self.pick(_EN_THINGS)] if self.r.random() < 0.6 else [self.pick(_EN_FREQUENT), self.pick(_EN_FREQUENT)]
            ws = ws if self.r.random() < 0.7 else [self.pick(_EN_HOW), *ws]
        else:
            ws = [self.pick(_FR_THINGS + _EN_THINGS), self.stem()]
            self.r.shuffle(ws)
        return " ".join(w.capitalize() for w in ws)

    def prose(self) -> str:
        """A plain sentence about things."""
        odd = self.r.random() < 0.6  # words no list holds
        a, b, c, d = (self.stem() if odd and self.r.random() < 0.7 else self.pick(w) for w in (_FR_THINGS, _FR_THINGS, _EN_THINGS, _EN_THINGS))
        n = self.r.randint(2, 999)
        return self.pick([
            f"Le {a} {self.pick(_FR_HOW)} {self.pick(_VERBS)} le {b} de {self.town()}.", f"Ce {a} {self.pick(_VERBS)} un {b} {self.pick(_FR_HOW)} pour {n} voix.", f"Chaque {a} et son {b} tiennent sur {n} pages.",
            f"Un {a} manque, puis le {b} {self.pick(_VERBS)} sans motif.", f"The {self.pick(_EN_HOW)} {c} {self.pick(_EN_VERBS)} the {d} near {self.town()}.", f"A {c} {self.pick(_EN_VERBS)} every {d} for {n} points.",
            f"{self.stem().capitalize()} {c} {self.stem()} the {d} and {n} of {self.stem()} {c} {self.stem()}.", f"L'{self.stem()} {self.stem()} à {n} et l'{self.stem(1)} {self.stem()} à {n},", f"{self.stem().capitalize()} {self.stem()} for {n} {self.stem()} of {self.stem()} {self.stem(1)}.", f"Un {a} {self.stem()} {self.stem(1)} le {b}, {self.stem(1)} {self.stem()} {self.stem()}.", f"No {c} {self.pick(_EN_VERBS)} this {self.pick(_EN_HOW)} {d}, but {n} others do.", f"Sur {n} cas, un {a} {self.pick(_VERBS)} la {self.pick(['suite', 'liste', 'règle', 'page'])}.",
        ])

    def given(self) -> str:
        g = self.pick(_GIVEN) if self.r.random() < 0.68 else self.stem(1)
        return "-".join(x.capitalize() for x in g.split("-"))

    def family(self) -> str:
        x = self.r.random()
        if x < 0.1:
            f = self.pick(["N'", "O'", "M'", "Mc", "Le ", "Da "]) + self.stem(1).capitalize()
        elif x < 0.2:  # a given name may be a family's
            f = self.pick(_GIVEN).title()
        else:
            f = self.stem(self.r.choice([0, 1, 1, 2, 2, 3]) or None).capitalize()
        if self.r.random() < 0.1:
            f += "-" + self.stem().capitalize()
        return f

    def digits(self, n: int) -> str:
        return "".join(self.pick("0123456789") for _ in range(n))

    def name(self) -> str:
        f = self.family()
        if self.r.random() < 0.35:
            f = f.upper()
        x = self.r.random()
        if x < 0.13:
            return f"{self.given()[0]}. {f.replace(' ', '')}"
        if x < 0.16:
            return f"{self.given()} {self.given()[0]}. {f}"
        if x < 0.24:
            return f"{self.given()} {self.given()} {f}"
        if x < 0.28:
            return f"{self.given()} {self.pick(['de ', 'van ', 'ben ', 'Ben ', 'El ', 'da ', 'di '])}{f}"
        if x < 0.31:
            return " ".join([self.given(), self.given(), f, *[self.family() for _ in range(self.r.randint(1, 2))]])
        return f"{f} {self.given()}" if x < 0.48 else f"{self.given()} {f}"

    def email(self) -> str:
        sep = self.pick(["_", ".", "-"])
        plain = lambda s: re.sub(r"[^a-z-]", "", unicodedata.normalize("NFKD", s).lower())
        g, f = plain(self.given()), plain(self.stem())
        user = self.pick([f"{g}{sep}{f}", f"{g[0]}{f}", f"{f}{self.r.randint(1, 99)}", f"accueil+{f}", "compta", "admin", "ventes", "hello", f"{g}-{f}.sav", f"{g[0]}.{f}", f"{g}{sep}{f}{sep}{self.r.randint(1, 9)}"])
        host = (self.stem() if self.r.random() < 0.1 else plain(self.stem())) + self.pick(["", "", "", "-ci", ".mail", "-group"])
        top = self.pick(["example", "test", "invalid", "com", "org", "ci", "fr", "net", "co.uk", "sn", "de", "gouv.fr", "edu"])
        at, dot = self.pick([("@", "."), ("@", "."), ("@", "."), (" @ ", "."), ("[at]", "[dot]"), ("(at)", "."), (" (at) ", " (dot) "), (" arobase ", " point "), (" at ", " dot "), ("(arobase)", "(point)"), ("<at>", "."), (" [at] ", " [point] ")])
        e = user + at + (host + "." + top).replace(".", dot)
        return e.upper() if self.r.random() < 0.07 else e

    def phone(self) -> str:
        sep = self.pick([" ", "-", ".", "/", "", " ", " "])
        x = self.r.random()
        if x < 0.12:
            return self.pick(["", "+1 ", "+1-"]) + self.pick([f"({self.digits(3)}) {self.digits(3)}-{self.digits(4)}", f"{self.r.randint(201, 989)}-{self.digits(3)}-{self.digits(4)}", f"{self.r.randint(201, 989)}.{self.digits(3)}.{self.digits(4)}"])
        if x < 0.2:
            return self.pick(["020 ", "+44 20 ", "+44 (0)20 ", "0161 "]) + f"{self.digits(4)} {self.digits(4)}"
        if x < 0.28:
            cut = self.pick([(2, 3, 2, 2), (3, 2, 2, 2), (3, 3, 3), (2, 3, 3)])
            return self.pick(["", "", "+221 ", "+237 "]) + self.pick([" ", " ", "-", "."]).join(self.digits(c) for c in cut)
        n = self.pick([5, 5, 5, 5, 4])
        pairs = [self.pick(["0" + self.digits(1), self.digits(2)])] + [self.digits(2) for _ in range(n - 1)]
        pre = self.pick(["", "", "", "+225 ", "+225" + sep, "(+225) ", "00225 ", "+33 ", "00 225 ", "+225", "+221 ", "(+33) "])
        return pre + sep.join(pairs)

    def ident(self) -> str:
        sp = " " if self.r.random() < 0.35 else ""
        up = lambda n: "".join(self.pick("ABCDEFGHJKLMNPRSTVWXYZ") for _ in range(n))
        forms = [
            lambda: up(2) + sp + sp.join([self.digits(3), self.digits(3), self.digits(3)]), lambda: "C" + sp + sp.join([self.digits(4), self.digits(4), self.digits(2)]), lambda: self.digits(2) + up(2) + self.digits(5), lambda: up(1) + sp + self.digits(8),
        ]
        if self.r.random() < 0.12:
            return self.pick([f"{self.digits(3)}-{self.digits(2)}-{self.digits(4)}", f"{self.pick('12')} {self.digits(2)} {self.pick(['01', '05', '11', '12'])} {self.digits(2)} {self.digits(3)} {self.digits(3)} {self.digits(2)}"])
        return self.pick(forms)()

    def street(self) -> str:
        head = self.pick(["du ", "de la ", "des ", "aux ", "de ", "du Bois des ", "du Pont des ", "des Anciens ", "du Puits des Trois ", "du Chemin des Vieux ", "des Quatre ", "aux ", "de l'", "d'"])
        if head.endswith(("s ", "x ")):
            return head + self.pick(_NOUNS)
        return head + ("A" if head.endswith("'") else "") + (self.stem().capitalize() if not head.endswith("'") else self.stem()) + (f" {self.family()}" if self.r.random() < 0.15 else "")

    def address(self) -> str:
        n = str(self.r.randint(1, 250))
        t = self.pick(_FR_STREET)
        x = self.r.random()
        if x < 0.25:
            return f"{self.pick(['lot', 'lot', 'Lot', 'villa', 'porte'])} {n}, îlot {self.r.randint(1, 20)}, {t} {self.street()}"
        if x < 0.5:
            return f"{t.capitalize()} {self.street()}, n° {n}"
        if x < 0.8:
            return n + self.pick([" ", " ", ", ", ", ", " bis, ", " bis ", " ter, "]) + f"{t} {self.street()}"
        return f"{n} {self.pick(_EN_NOUNS)} {self.pick(_EN_STREET)}"

    def site(self) -> str:
        return re.sub(r"[^a-z]", "", unicodedata.normalize("NFKD", self.stem()).lower()) + self.pick([".com", ".ci", ".example", ".org"])

    def number(self) -> str:
        return str(self.r.randint(1, 9999))

    def amount(self) -> str:
        return self.pick([" ", " ", ".", "", " "]).join([str(self.r.randint(1, 999)), self.digits(3), self.digits(3), self.digits(3)][self.r.choice([0, 0, 1, 2]) :])

    def date(self) -> str:
        d, m = self.r.randint(1, 28), self.r.randint(1, 12)
        return self.pick([f"{d:02}/{m:02}/20{self.r.randint(10, 29)}", f"20{self.r.randint(10, 29)}-{m:02}-{d:02}", f"{d:02}.{m:02}.{self.r.randint(1980, 2029)}"])

    def moment(self) -> str:
        return f"{self.date()} {self.r.randint(0, 23):02}:{self.r.randint(0, 59):02}:{self.r.randint(0, 59):02}"

    def case(self) -> str:
        """Numbers of cases, files, firms."""
        y = self.r.randint(2015, 2029)
        up = "".join(self.pick("ABCDEFGHJKLMNPRSTVWXYZ") for _ in range(self.r.randint(2, 4)))
        return self.pick([f"{up}-{self.digits(6)}", f"{up}{self.digits(6)}", f"{y}-{self.digits(6)}", f"{up[0]}/{self.digits(6)}/{y % 100}", self.digits(4), "0" + self.digits(9), self.digits(10), self.digits(9), self.digits(8), "10" + self.digits(5), f"{y}/{self.digits(5)}", f"{self.digits(3)} {self.digits(4)} {self.digits(3)}"])


#: {n} name, {g} known given name and family name, {f} family name after a title, {e} e-mail, {p} phone, {i} id, {a} address: personal information.
_WITH = """
[Le compte rendu|La synthèse|L'avis] de {n} [est attendu|manque encore|reste à relire].
[Hier|Lundi|Ce matin], {n} [a quitté|a rejoint|a visité] [le chantier|l'atelier|la réunion] [de {T}|à {T}|du site].
{n} [habite|travaille|enseigne|étudie] à {T} depuis {d} ans.
[Selon|D'après|Pour] {n}, [rien ne presse|la panne vient du moteur|tout est réglé].
[Madame|Monsieur|Mme|Mlle|Dr|Me|M.] {n} [a rendu les clés|souhaite un rendez-vous|passera mardi|ne viendra pas].
[Mme|Mlle|Dr|Me|Madame|Monsieur|Pr] {f} [a rendu les clés|souhaite un rendez-vous|passera mardi|n'a rien reçu].
[madame|monsieur|docteur] {f} [est en congé|nous attend]
La [plainte|lettre|fiche|visite] de [Mme|Mlle|Monsieur|Dr] {f} [date de|remonte à] mars.
[Patient|Patiente|Locataire|Client|Élève|Auteur|Témoin|Nom|Nom complet|Responsable|Médecin|Contact] : {n}
[Patient|Locataire|Client|Élève|Auteur|Témoin|Ayant droit] ; {n} ; [actif|mensuel|sorti]
[nom|name|client|author|owner|utilisateur]={n};[statut|role|lang]=[CDI|admin|fr]
{"[auteur|client|name|patient|owner]": "{n}", "[age|rang]": {d}}
<[nom|author|client]>{n}</[nom|author|client]>
[Reçu|Relu|Approuvé|Validé|Signé|Rédigé|Préparé] par {n}[.| le {D}.| à {T}.]
[Signé|Signature|Pour copie conforme] : {n}, [greffier|directrice|chef de file|notaire].
[Bien à vous|Sincères salutations|Respectueusement|À bientôt],\\n{n}\\n
[Participants|Membres|Excusés|Absents] : {n}, {n} et {n}.
[Participants|Membres|Attendees] : {n}, le [trésorier|gardien] et deux [élus|voisins].
[Remis|Adressé|Confié|Envoyé] à {n} [contre reçu|pour relecture|sans délai].
[L'infirmière|Le gardien|Le notaire|L'élève|Le chauffeur|La caissière] {n} [a tout noté|était absent|confirme l'heure].
[Présents|Membres|Contact] : [Mme|M.|Dr|Madame|] {g} [Responsable|Chef|Directrice|Adjoint|Caissier] {H}[.|]
{g} [Directeur|Responsable|Chef|Manager|Director|Head of] {H}[.|, {T}.]
[Suivi|Présents|Visa] : [Mme|M.|Dr|Madame] {g} [Responsable|Chef|Cheffe] {H} {H}[.|]
[Mme|M.|Monsieur|Madame] {g} {g} {g}[.|]
La [note|lettre] de [{n}|{n}|{g}] est [attendue|perdue|classée].
Le [dossier|rapport|bilan] [de|par] [{n}|{n}|{g}] est [attendu|perdu|classé].
Nous soussignés {n} et {n} [déclarons|attestons] ce qui suit.
Je soussignée {n}, [bailleresse|tutrice], atteste sur l'honneur.
[La date de sortie|Le numéro de contrat|L'âge exact|Le dossier médical] de {n} [est inconnu|manque au registre|n'est pas saisi].
{n} [nous a écrit|a rappelé|a signé|attend une suite|n'a rien payé|conteste la note].
Le [loyer|solde|forfait|congé] de {n} [est payé|a doublé|court encore].
Avez-vous vu {n} au [guichet|marché] ?
[Bonjour|Cher|Chère|Dear|Hello] {n},
[The report|A letter|This note|The claim] [by|from|of] {n} is [late|missing|on file].
[According to|As told by|Per] {n}, [the pump failed|nothing was lost|it rained].
{n} [called back|left early|moved out|paid in cash|signed the lease|lives in {T}].
M. {n} [a rendu les clés|souhaite un rendez-vous|passera mardi|demande un reçu|a déposé plainte].
[Selon|Pour|Chez|Vu par] M. {n}[.|, rien ne presse.]
M. {g} [a payé|répondra demain|n'est pas venu].
[Mr|Mrs|Ms|Dr|Mr.|Mrs.|Dr.] {f} [will call|moved out|was not at home|agreed].
[Mr|Mrs|Ms|Dr|Mr.] {n} [will call|moved out|was not at home|agreed].
[Written|Checked|Prepared|Approved|Reviewed|Handled] by {n}[.| on {D}.]
[Sent|Given|Passed] to {n} [for review|in person|without reply].
[Best|Kind regards|Yours faithfully|Cheers],\\n{n}\\n
[Patient|Tenant|Driver|Buyer|Author|Owner|Student] [name: |: ]{n}
The [nurse|driver|clerk|buyer|student] {n} [saw it|came late].
The [rent|bonus|salary|loan|leave] of {n} [was doubled|ended|is due].
[The birth date|The exit date|The file] of {n} [is unknown|is empty].
Signed, {n}, [notary|treasurer].
Did {n} [reply|pay] yet?
{g} {g} {g}
[Présents|Liste|Équipe] : {g} {g} {g} {g}
[Selon|D'après|Chez|Pour|Vu par|Reçu par|Transmis à] [Mme|Mlle|Dr|Me|Monsieur|Madame|Pr] {f}[.|, rien ne presse.| lundi.]
[For|From|Seen by|Per|According to] [Mr|Mrs|Ms|Dr|Mr.|Dr.] {f}[.|, nothing was lost.]
[Merci d'écrire|Envoyez vos photos|Répondez] à {e} [avant lundi|s'il vous plaît|dès que possible].
[E-mail|Mail|Courriel|Adresse mail|email] [: |= ]{e}
[À|Cc|Cci|To|Reply-To|Expéditeur] : {e}
[Désinscription|Abonnement] : <{e}>[.| sous deux jours.]
[Le courriel|L'e-mail|Un mot] de {e} [s'est perdu|attend une suite].
[From|Sender|De la part de|Mailto|Web|Support] : {e}
[mailto:|courrier:|@ ]{e}
[Nouvelle adresse|Ancien compte] {e}[.|, merci d'en tenir compte.]
[Ask|Ping|Notify] {e} [first|and wait].
[mail|user|login]={e};[lang|role]=fr
{"[mail|login]": "{e}"}
[Contact us at|Write to|Send it to|Ask] {e} [for details|today|before noon].
The address {e} [bounced|is no longer read].
Son compte ([{e}|{e}]) est bloqué.
(copie : {e})
[Appelez|Contactez|Joignez] [la boutique|le cabinet|le gardien|l'école] au {p}[.| avant 18 h.| le samedi.]
[Tél.|Tel|Téléphone|Mobile|Portable|Fax|GSM|Ligne directe|Cabinet|Portable] [: |]{p}
[Elle|Il] [répond|est joignable|préfère être rappelé] au {p}.
[SMS|WhatsApp|Texto] au {p} [uniquement|après la visite].
[Numéro|N°] du [gardien|médecin|voisin] : {p}
[phone|tel|mobile|gsm]={p};[lang|role]=fr
{"[tel|mobile|phone]": "{p}"}
[Call|Ring|Text|Reach] [us|me|the shop|the clinic] [at|on] {p}[.| any day.| before five.]
[Call|Dial|Text|Try] {p} [first|tonight|after lunch|and wait].
[Phone|Cell|Mobile|Fax|Office line|Direct line] [: |]{p}
[Her|His|The clinic's] number is {p}.
Laissez un message au {p}, [merci|sans faute].
[{p}|{p}] (domicile)
Cel {p} / [bureau fermé|domicile néant]
(mobile {p})
[Urgences|Secrétariat|Accueil|Numéro vert|Astreinte|En cas d'urgence :] {p}[.|]
[On a noté|Elle n'a donné que] le {p} [au dos du reçu|sur la fiche].
Pour [toute panne|un devis], un seul numéro : {p}.
[Carte d'identité|CNI|Passeport|Titre de séjour|Permis de conduire] [n° |numéro |: |]{i}[.| périmé.| perdu.]
[Le passeport|La carte|La pièce d'identité] {i} [a été volée|n'est plus valable|ne se lit plus].
[Patient|Assurée|Assuré|Adhérent|Travailleur] {i} [admis lundi|sans médecin|radié].
[Matricule|Identifiant|Immatriculation|N° d'assuré|Numéro de sécurité sociale|NIR] [: |]{i}
[ID_INDIV|id_personne|matricule|badge|assure]={i};[x|lang]={d}
matricule;{i};[sorti|actif];{d}
{"[matricule|passport|id_card]": "{i}"}
[ID card|Passport|Driving licence|Insurance number|Social security number|Worker id] [no. |number |: |]{i}[.| was lost.]
[The passport|The badge|The licence] {i} [was found|has run out].
[Holder|Member|Worker|Patient] {i} [left in May|is unknown here].
Une carte (n° {i}) a été trouvée.
[ligne {d}] {i} : [âge manquant|doublon]
L'assurée {i} [revient deux fois|n'a pas de fiche].
[Adresse|Domicile|Livraison|Siège social|Lieu de travail|Résidence] : {a}[.|, {T}.| ({T})|]
[Elle|Il] [habite|loge|demeure] [au |]{a}[.|, à {T}.| à {T}.]
[Livrer|Déposer|Renvoyer] [le colis|les clés] au {a}[.|, {T}.]
[Rendez-vous|Visite|Réunion] [lundi|mardi|samedi] au {a}[.|, {T}.| à {T}.]
[La boutique|Le cabinet|L'atelier] du {a} [ferme|a brûlé|déménage].
[adresse|addr|lieu]={a};[x|lang]=fr
{"[adresse|address]": "{a}"}
[Address|Home|Ship to|Office|Shop] : {a}[.|, {T}.]
[She|He] [lives|works|stays] at {a}[.|, {T}.]
[The shop|The flat|The parcel] [at|sent to] {a} [was empty|was returned].
Un pli posté au {a} [s'est perdu|n'est pas arrivé].
[Déménagement|Transfert] : {a} ([{T}|{T}]).
{n}, {a}, {T}
{n} - {p} - {e}
{n} ({e}), {p}
[Patient|Client] : {n} / {i} / {p}
"""
#: No personal information. {T} town, {F} firm, {H} heading, {d} short number, {K} case number, {M} amount, {D} date, {L} moment, {S} prose, {W} web site, {B} post box.
_WITHOUT = """
{S}
{S}
{S}
{H} : {S}
[Le|La] {H} [se réunit|est clos|a répondu] [à {T}|en mai|le {D}].
{H} et {H} [sont prévenus|ont répondu|se partagent les frais].
The {H} [met|answered|is closed] [in {T}|on {D}].
[See|Voir] {H}, page {d}.
{H}\\n
{F} [a ouvert|possède|recrute] {d} [boutiques|camions|chauffeurs] à {T}.
{F} [livre|paie|répond] [tard|peu|toujours].
[L'usine|Le siège|La filiale] de {F} [ferme|déménage|a brûlé].
[Chez|Avec|Sans] {F}, [les prix montent|rien ne change|la caisse est vide].
[Remis|Adressé|Envoyé|Confié] à {F} [contre reçu|sans délai].
[Sent|Given|Passed] to {F} [for review|without reply].
[Client|Fournisseur|Supplier|Contact|Nom] : {F}
{F} [opened|owns|sold] {d} [shops|trucks] in {T}.
{F} [pays late|never replied|called back|wins the tender].
[Nobody|Someone|A clerk] at {F} [knew the price|signed for it].
Le compte de {F} [est payé|a doublé|court encore].
[À|Près de|Vers] {T}, [la route est coupée|il pleut|le marché ouvre à {d} h].
[La mairie|Le port|La gare|L'hôpital] de {T} [compte {d} agents|ferme tôt|attend des fonds].
{T} [compte {d} habitants|vote en mai|reste isolée].
[La rue|L'avenue|Le boulevard|La place] [centrale|marchande|du marché] [est barrée|compte {d} étals].
[Rue|Place|Avenue] [barrée|fermée] [aux vélos|jusqu'au {D}].
[The road|A street|The lane] to {T} is [closed|wet].
[BP|B.P.|Case postale|B. P.] {d} {T}
[Adresse postale|Courrier] : {d} BP {d}, {T}
[Case postale|BP :|Courrier :|Poste restante,|PO box] {B}[.|, {T}.| {T}]
[Au|À] [l'étage|l'arrêt] {d}, [porte|allée] {d}.
[Dossier|Ticket|Sinistre|Commande|Facture|Devis|Colis|Contrat|Série|Réf.] [n° |: |]{K}[.| clos.| en cours.]
[Votre|Notre|Cette|La] [commande|facture|référence|police] {K} [est réglée|part demain|a expiré|traîne depuis le {D}].
[Order|Invoice|Ticket|Claim|Parcel|Batch|Case|Policy] [no. |number |: |]{K}[.| is open.| shipped.| was opened on {D}.]
[Le bon|Le reçu|L'avis] numéro {K} [manque|ne se lit plus|suit par la poste].
[order_id|ref|batch|ticket]={K};[x|lang]={d}
{"[ref|order|lot]": "{K}"}
[L'employeur|L'entreprise|Le fournisseur|La société] {K} [a fermé|ne répond pas|doit deux mois].
[The employer|The supplier|Vendor] {K} [closed|owes two months].
[Le compte|Compte bancaire|IBAN|RIB] {K} [est gelé|a été soldé].
[Le total|Le coût|Le loyer|Une amende] [de |est de |atteint ]{M} [francs|FCFA|euros|F].
[Total|Somme|Solde|Reste dû] : {M} [FCFA|F|EUR|€]
[The cost|The price|A fine|The debt] [of|is|reached] {M} [francs|euros|XOF|dollars].
Entre {M} et {M}, [le choix est simple|l'écart compte].
({M}) contre ({M})
{M} [habitants|kg|votes|tonnes|pages|mots].
{d};{K};{M};{d};[OK|KO]
{d},{M},{D},[x|y]
[Le|Du|Depuis le|Avant le|On] {D}[, la gare ferme.|, the gate was shut.|]
[{L}] [INFO|DEBUG|WARN|ERROR] [module|job|task] {d} [done|failed|started]
{L} [GET|POST] /[api|v2]/{d} {d}
[INFO|DEBUG|WARN] {H} {d}
[version|Version|build] {d}.{d}.{d}
[x|total|seuil|alpha] = {d}.{d}e-{d}; [assert|print]([x|y] > {d})
[SELECT|UPDATE|DELETE] [FROM|SET] [t_ventes|stock] [WHERE|LIMIT] {d} [ORDER BY|GROUP BY] {d} -- {d}{d}
[Horaires|Ouvert|Open] : {d} 30 - {d} 00
[De|From] 8 30 [à|to] 17 00 00, [sauf|but not] [lundi|Sunday].
[Suivez|Follow] @[marche|stock|ventes]_{d} [pour la suite|for news].
[prix@stock|cle@valeur|node@cluster] [est un champ|is a key] [vide|once more].
[pip|npm] install [outil|calcul-des-primes|x]@{d}.{d}.{d}
[Ouvert|Open|Closed|Meet] at {d}.{d}
[Look|See us|Visit us] at {W}
{W}/[@page|ventes@{d}]
module [tri|rangement_des_fiches]@{d}.{d} [chargé|loaded]
[Le|La] [score|note] {d} / {d} [suffit|baisse].
[Question|Objet|Sujet|Titre] : [que dire|où signer|pourquoi attendre] ? [Réponse|Avis] : [rien|plus tard].
[Lundi|Mardi|Samedi] {d} [mars|avril|mai|Janvier], [fermeture|inventaire].
[January|March|Friday] {d}: [closed|inventory].
[Le domaine|La filière|The sector] [{H}|« {H} »] [recule|gagne {d} points].
[La colonne|Column|Le champ] [PRIX_NET|QTE_STOCK|CODE_ART|VILLE_DEP] [est vide|is empty|n'a plus de zéros].
Le modèle {K} [consomme|pèse] {d} [kg|W].
[222222222222|000000000111]{d}{d}
[GUICHET|CAISSE|SORTIE|ENTRÉE] [FERMÉE|OUVERTE] [LE SAMEDI|EN MAI]
[ATTENTION|RAPPEL|NOTE] : {S}
"""


def _alternatives(pattern: str, r: random.Random) -> str:
    """One of each [a|b]; brackets without a bar stand for themselves."""
    while m := re.search(r"\[([^\[\]]*\|[^\[\]]*)\]", pattern):
        pattern = pattern[: m.start()] + r.choice(m[1].split("|")) + pattern[m.end() :]
    return pattern


def _patterns(block: str) -> list[str]:
    return [p.replace("\\n", "\n") for p in block.strip().split("\n")]


def _known() -> frozenset[str]:
    """Words in small letters that the patterns use: they make up no name."""
    text = " ".join([_WITH, _WITHOUT, *_FR_THINGS, *_FR_HOW, *_EN_THINGS, *_EN_HOW, *_VERBS, *_EN_VERBS, *_FR_FREQUENT, *_EN_FREQUENT])
    flat = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return frozenset(w.lower() for w in re.findall(r"[^\W\d_]{3,}", re.sub(r"\{.\}", " ", flat)) if w.lower() not in GIVEN) | BREAK


KNOWN = _known()


def sample(n: int, seed: int) -> Iterator[tuple[str, list[tuple[str, int, int]]]]:
    """n texts of a few sentences with their labelled spans (kind, start, end)."""
    m = _Maker(seed)
    yes, no = _patterns(_WITH), _patterns(_WITHOUT)
    loud = [p.replace("{n}", "{g}") for p in yes if "{n}" in p and not re.search(r"\{[fgepia]\}", p)]
    make = {"n": ("name", m.name), "e": ("email", m.email), "p": ("phone", m.phone), "i": ("id", m.ident), "a": ("address", m.address)}
    plain = {"T": m.town, "F": m.firm, "H": m.heading, "d": m.number, "K": m.case, "M": m.amount, "D": m.date, "L": m.moment, "S": m.prose, "W": m.site, "B": lambda: f"{m.r.randint(1, 29):02} {m.pick(['BP', 'BP', 'B.P.', 'CP'])} {m.number()}"}

    def family() -> str:
        f = m.family()
        return f.upper() if m.r.random() < 0.3 else f

    make["f"] = ("name", family)
    make["g"] = ("name", lambda: f"{m.pick(_GIVEN).title()} {m.pick(_GIVEN).title() if m.r.random() < 0.3 else m.stem().capitalize()}")
    for _ in range(n):
        text, spans = "", []
        shout = m.r.random() < 0.22  # a text in capitals: of names, those with a known given name alone tell themselves
        end = m.pick([" ", " ", "\n", "\n\n", "  ", "\r\n"])
        for _ in range(m.r.randint(1, 5)):
            t = _alternatives(m.pick(loud if shout else yes) if m.r.random() < (0.06 if shout else 0.57) else "{S}" if shout and m.r.random() < 0.5 else m.pick(no), m.r)
            for piece in re.split(r"(\{[a-zA-Z]\})", t):
                if len(piece) == 3 and piece[0] == "{" and piece[1] in make:
                    kind, f = make[piece[1]]
                    v = f()
                    spans.append((kind, len(text), len(text) + len(v)))
                    text += v
                elif len(piece) == 3 and piece[0] == "{" and piece[1] in plain:
                    text += plain[piece[1]]()
                else:
                    text += piece
            text += end if t[-1] in ".?!" else "\n"
        yield (text.upper() if shout else text), spans
