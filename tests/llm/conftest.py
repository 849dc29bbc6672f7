from hypothesis import settings

settings.register_profile("spark", deadline=None)
settings.load_profile("spark")
