"""Outline of a mountain range from the public-domain Natural Earth 1:10m physical regions.

Longitude and latitude of the ring, in its order; the last point closes it.
"""

RING = (
    (84.9080916675837, 29.178717352337856), (87.39368737070876, 29.133612371869106), (87.71729576914626, 29.25714752811905),
    (88.05774987070876, 29.320440985150384), (92.47315514414626, 29.102972723431606), (93.20167076914626, 28.906988836712827),
    (93.3657332691462, 28.887579657025384), (93.5201522144587, 28.89789459843155), (93.6193953785212, 28.927008367962827),
    (93.90308678477126, 29.112738348431634), (94.39356530039626, 29.243475653119106), (94.77684993786377, 29.42626802902157),
    (94.9063826832087, 29.488043524212827), (95.1638289722712, 29.7281558289003), (95.21412194102126, 29.757025457806606),
    (95.2706404957087, 29.775213934369077), (95.3310653003962, 29.782110907025356), (95.39332115977126, 29.777594305462827),
    (95.45521080820876, 29.761114813275356), (95.5146590503962, 29.732367254681577), (95.56934655039626, 29.690985418744077),
    (95.6171981128962, 29.636542059369077), (95.64259021118593, 29.595117723838143), (95.6506453785212, 29.581976629681577),
    (95.65578774229093, 29.564345668185467), (95.66260826914626, 29.54096100468155), (95.65565026133376, 29.510199285931606),
    (95.63221276133376, 29.486273504681606), (94.95899498789626, 29.194220282025327), (94.8951522144587, 29.151312567181577),
    (94.8471785816462, 29.10407135624405), (94.79639733164626, 29.009527899212856), (94.7905379566462, 28.921576239056577),
    (94.8206893238337, 28.840155340619106), (94.8776961597712, 28.7651431335878), (95.25501549570876, 28.4752261414003),
    (95.28296959727126, 28.43402741093155), (95.2891951832087, 28.397467352337856), (95.2745467457087, 28.322333074994134),
    (95.2727156910212, 28.275702215619134), (95.2869979175837, 28.217718817181634), (95.31032126336933, 28.174816699475144),
    (95.32691490977126, 28.1442935242128), (94.90871507974609, 27.802220027562498), (94.3471785816462, 27.342901922650384),
    (93.8300887378962, 27.12433502811905), (91.68238365977126, 26.859808660931577), (89.64548922831452, 26.902885157717236),
    (89.5899764332087, 26.904059149212827), (89.3828231128962, 26.953802801556634), (89.19759383123429, 27.02816629004576),
    (88.9002791675837, 27.147528387494077), (88.80066979258376, 27.16010162968155), (88.68677819102126, 27.149481512494106),
    (88.65294442600717, 27.136959795369336), (88.25123131602126, 26.988287664837827), (87.7805281910212, 26.903998114056606),
    (87.018733656065, 27.026631888104788), (85.33692467539626, 27.297369696087827), (84.6657820972712, 27.573065496869077),
    (83.85926354258376, 27.701361395306606), (83.72950280039626, 27.746771551556606), (83.50135338633376, 27.87470123905655),
    (83.29737389414626, 27.95184967655655), (82.4868270191462, 28.014532782025327), (82.39795983164626, 28.04901764530655),
    (82.0001326832087, 28.378729559369077), (79.30512464937934, 29.95884992784528), (77.3139754566462, 31.126288153119106),
    (75.94908996806211, 32.226118920893896), (75.71985924570876, 32.410834051556634), (75.5824080738337, 32.60224030155655),
    (75.55441175553133, 32.68123394563759), (75.5218611988337, 32.77307770390033), (75.5310164722712, 32.91974518436908),
    (75.5948592457087, 33.04907868046283), (76.0915633472712, 33.52741119999405), (76.2004500660212, 33.67096588749408),
    (76.2733260425837, 33.743109442181634), (76.3818465503962, 33.79071686405655), (77.00008938128818, 33.866127149166005),
    (77.37562096445876, 33.91193268436905), (77.49024498789626, 33.872015692181606), (78.02939805239416, 33.52281548361637),
    (78.22437548371042, 33.396531939731545), (84.52064049570876, 29.31854889530655), (84.9080916675837, 29.178717352337856),
)
