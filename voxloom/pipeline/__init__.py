"""The stages of the corpus, from recordings to the release."""
