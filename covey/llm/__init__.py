"""Operations of a training-data pipeline. One module per operator; nothing else imports this."""
