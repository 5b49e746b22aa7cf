"""Accepted values of the search vocabularies."""

# fixed values: genres
GENRES = [
    "Nudity", "Violent", "Gore", "Education", "Accounting", "Animation & Modeling", "Tutorial",
    "Software Training", "Strategy", "Free To Play", "Documentary", "Early Access", "Movie",
    "Audio Production", "Racing", "Photo Editing", "Short", "Utilities", "Sports", "Casual",
    "Sexual Content", "Design & Illustration", "Adventure", "Indie", "Action", "Web Publishing",
    "Simulation", "RPG", "Video Production", "Game Development", "Massively Multiplayer", "360 Video",
    "Episodic",
]

# fixed values: categories
CATEGORIES = [
    "Full controller support", "Commentary available", "Steam Workshop", "Includes Source SDK",
    "SteamVR Collectibles", "Steam Cloud", "VR Supported", "Mods", "Steam Achievements", "Single-player",
    "Custom Volume Controls", "Includes level editor", "Co-op", "LAN PvP", "PvP", "In-App Purchases",
    "Cross-Platform Multiplayer", "Surround Sound", "Mods (require HL2)", "Family Sharing",
    "Captions available", "Remote Play on Tablet", "VR Only", "Stats", "Camera Comfort",
    "Chat Text-to-speech", "Steam Leaderboards", "Chat Speech-to-text", "Narrated Game Menus",
    "Remote Play Together", "Playable without Timed Input", "Mouse Only Option", "Stereo Sound",
    "Adjustable Text Size", "Steam Turn Notifications", "Remote Play on Phone", "Steam Trading Cards",
    "Steam Timeline", "HDR available", "Online PvP", "Subtitle Options", "Remote Play on TV",
    "LAN Co-op", "Shared/Split Screen", "Online Co-op", "VR Support", "Touch Only Option",
    "Tracked Controller Support", "MMO", "Partial Controller Support", "Multi-player", "Save Anytime",
    "Valve Anti-Cheat enabled", "Shared/Split Screen Co-op", "Shared/Split Screen PvP",
    "Adjustable Difficulty", "Color Alternatives", "Keyboard Only Option",
]

# fixed values: review score descriptions
REVIEW_SCORE_DESCRIPTIONS = [
    "Mostly Positive", "5 user reviews", "Positive", "Mostly Negative", "Mixed", "7 user reviews",
    "4 user reviews", "Overwhelmingly Negative", "Negative", "Overwhelmingly Positive", "9 user reviews",
    "8 user reviews", "Very Positive", "No user reviews", "2 user reviews", "3 user reviews",
    "Very Negative", "1 user reviews", "6 user reviews",
]
