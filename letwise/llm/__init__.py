"""Operations of a training-data pipeline: URL rules, decontamination, exact top-k, duplicate removal,
personal data, quality and mixing. Nothing else in the library imports this subpackage."""
