"""Words that tell personal information from its look-alikes: fixed values, lower case, without accents."""

from __future__ import annotations

TITLES = frozenset("m mm mme mmes mlle mr ms mrs dr pr prof me monsieur madame mademoiselle maitre docteur professeur miss mister sir".split())
#: Titles that are also written in lower case before a name.
LOW_TITLES = ("monsieur", "madame", "mademoiselle", "docteur", "maître", "professeur")
PERSON = frozenset(
    "agent soussigne soussignee salarie salariee employe employee par selon signe signed contact presents present nom name beneficiaire cordialement according "
    "handled forwarded transmis vu apres wage salaire embauche hire suivi regards sincerely gerant interlocuteur responsable assure ouvrier titulaire prenom for by of to from "
    "patient client voisin temoin auteur locataire eleve collegue pere mere frere soeur fils fille epoux epouse author tenant student colleague father mother brother sister wife husband "
    "neighbour witness customer user utilisateur usager docteur avocat notaire infirmier infirmiere chauffeur driver nurse lawyer manager director directeur directrice".split()
)
PHONE = frozenset("tel telephone portable cel cell cellulaire mobile gsm whatsapp phone call fax joindre rappeler appeler urgence standard appelez contact ring dial sms texto telephonique appel joignable reach".split())
IDENT = frozenset(
    "matricule carte piece identite passeport passport assure salarie worker card id id_indiv cni ligne identity holder titulaire immatriculation badge permis licence license insurance securite social nir ssn patient".split()
)
CASE = frozenset(
    "dossier demande case reference ref bordereau compte account facture invoice lot version file fichier employeur employer ticket commande contrat marche base interne "
    "quittance recu cheque rib iban numero_employeur order batch serial serie article produit devis policy police claim sinistre tracking colis parcel build commit page chapitre".split()
)
MONEY = frozenset("fcfa francs franc f xof cfa euros euro dollars lignes rows enregistrements records bulletins ecus percent mois jours heures kg km tonnes litres metres points votes habitants units unites".split())
PLACE = frozenset("domicile siege office adresse address reside habite lives visite courrier bureaux mail demeurant residence home situe sis demeure loge livrer livraison deliver located clinique atelier boutique shop".split())
FIRM = frozenset(
    "sa sarl sas sasu eurl snc gie ltd llc inc plc corp gmbh bv international industries services negoce holding groupe group cie compagnie company reunis freres associes et fils "
    "consulting agence bureau direction caisse commune ministere banque cabinet societe entreprise etablissements ets office service departement division conseil "
    "partners bank trust hotel clinique hopital hospital universite university college lycee ecole institut institute fondation foundation association mutuelle assurances transports logistique".split()
)
STREET = frozenset("rue avenue boulevard quai allee chemin place impasse route ruelle passage square cite villa carrefour cours street road lane drive close terrace court way".split())
#: Words that no name holds, between capitalised words too.
BREAK = frozenset(
    "les un une des nous vous il elle on ce cette ces mon notre votre leur leurs son sa ses the an this that these those we you they he she it in at to of and or et ou mais dans pour avec sans "
    "sous sur depuis chez apres avant selon par est sont a ete aux au en ne pas que qui dont si is are was were be been has have had for with from by as not but if when where while after before "
    "objet question reponse note merci bonjour dear bonsoir hello".split()
)
#: Words that stand inside a name but end none, and begin one only after a title.
PARTICLE = frozenset("de du d la le van von der den ben bin el al da dos di del ould".split())
COMMON = frozenset(
    "faute merci cordialement bonjour objet question reponse note document service direction generale principal "
    "general bureau caisse commune ministere agence column account case worker identity card carte matricule piece numero visite siege domicile office mail call write contact "
    "copie adresse present presents signe signed dossier base total version lot compte standard boite postale numero january february march april may june july august september "
    "october november december janvier fevrier mars avril mai juin juillet aout septembre octobre novembre decembre lundi mardi mercredi jeudi vendredi samedi dimanche "
    "monday tuesday wednesday thursday friday saturday sunday nord sud est ouest north south east west select from where group order table".split()
)
GIVEN = frozenset(
    "abel abdoulaye abou adama adele adjoua affoue agnes ahmed aicha akissi alain albert alexandre alice alima aline amadou amara amelie amenan aminata amy andre angele anna anne "
    "antoine armand arnaud arthur assane assetou aurelie awa aya ayoub bakary beatrice benoit bernard bintou blaise boubacar brice bruno camille carine carlos catherine cecile celine "
    "charles cheick chantal christian christine clarisse claude claire clement cyrille daniel david delphine denis desire diane didier djeneba dominique drissa edith edmond "
    "edouard edwige elena elie elise emile emily emma emmanuel eric esther estelle eugene eve fabrice fanta fatou fatoumata felix fernand firmin florence francois francoise gabriel georges "
    "gerard gilles gisele grace guillaume guy habib hamed hannah helene henri herve hortense hugo ibrahim idriss ines irene isabelle issa jacques james jean jean-noel jeanne john joseph "
    "judith jules julia julie karim kofi koffi konan kouame kouassi lamine laura laurent lea leon linda louis lucas lucie lydie madeleine maria mamadou marc marcel marguerite mariam marie marie-ange mark martin "
    "mary mathieu michael michel mireille mohamed monique moussa nadege nathalie nicolas noel odile olivier omar oumar ousmane pascal patrice patrick paul pauline pedro pelagie peter philippe pierre "
    "rachel raymond rene richard robert roger rokia rosa rosine salif salimata samuel sandrine sarah sekou serge seydou simon solange sofia sophie souleymane stephane susan suzanne sylvie "
    "therese thierry thomas valerie victor vincent william yao yacouba yves zeinab".split()
)
CLASSES = (TITLES, PERSON, PHONE, IDENT, CASE, MONEY, PLACE, FIRM)
