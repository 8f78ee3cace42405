"""Operations of a training-data pipeline: one module per operator, ``queries`` and ``oracle`` for the catalogue."""
