"""Controlled vocabularies of the metadata schema.

Fixed values: they must equal the published vocabularies.
"""

RELATION_TYPES = tuple(
    """
    IsCitedBy Cites IsSupplementTo IsSupplementedBy IsContinuedBy Continues IsDescribedBy Describes
    HasMetadata IsMetadataFor HasVersion IsVersionOf IsNewVersionOf IsPreviousVersionOf IsPartOf HasPart
    IsPublishedIn IsReferencedBy References IsDocumentedBy Documents IsCompiledBy Compiles IsVariantFormOf
    IsOriginalFormOf IsIdenticalTo IsReviewedBy Reviews IsDerivedFrom IsSourceOf IsRequiredBy Requires
    IsObsoletedBy Obsoletes IsCollectedBy Collects IsTranslationOf HasTranslation
    """.split()
)

RELATED_IDENTIFIER_TYPES = tuple(
    """
    ARK arXiv bibcode CSTR DOI EAN13 EISSN Handle IGSN ISBN ISSN ISTC LISSN LSID PMID PURL RRID UPC URL URN
    w3id
    """.split()
)

RESOURCE_TYPES_GENERAL = tuple(
    """
    Audiovisual Award Book BookChapter Collection ComputationalNotebook ConferencePaper ConferenceProceeding
    DataPaper Dataset Dissertation Event Image InteractiveResource Instrument Journal JournalArticle Model
    OutputManagementPlan PeerReview PhysicalObject Poster Preprint Presentation Project Report Service
    Software Sound Standard StudyRegistration Text Workflow Other
    """.split()
)

CONTRIBUTOR_TYPES = tuple(
    """
    ContactPerson DataCollector DataCurator DataManager Distributor Editor HostingInstitution Producer
    ProjectLeader ProjectManager ProjectMember RegistrationAgency RegistrationAuthority RelatedPerson
    Researcher ResearchGroup RightsHolder Sponsor Supervisor Translator WorkPackageLeader Other
    """.split()
)

NAME_TYPES = ("Organizational", "Personal")

FIELDS = tuple(
    """
    alternateIdentifiers creators titles publisher publicationYear subjects contributors dates language
    types relatedIdentifiers relatedItems sizes formats version rightsList descriptions geoLocations
    fundingReferences
    """.split()
)

ACTIONS = ("update", "updateChild", "insert", "deleteChild")
